"""CTC decoding of per-step log-probabilities.

Long form: one row per (line_id, t) with ``log_probs``; steps of a line are
gathered by one shuffle, and all else is local to the line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.strings import bound


def check_vocab(vocab: list[str], classes: int) -> None:
    if len(vocab) != classes:
        raise ValueError(f"vocabulary has {len(vocab)} entries for {classes} classes")


def log_softmax(scores: Column) -> Column:
    """Natural logs of the softmax of an array, computed around its maximum."""

    def shifted(x: Column) -> Column:
        return bound(F.array_max(x), lambda top: F.transform(x, lambda v: v - top))

    def less_total(x: Column) -> Column:
        return bound(F.log(F.aggregate(x, F.lit(0.0), lambda a, v: a + F.exp(v))), lambda total: F.transform(x, lambda v: v - total))

    return bound(bound(F.transform(scores, lambda v: v.cast("double")), shifted), less_total)


def log_sum_exp(a: Column, b: Column) -> Column:
    return F.greatest(a, b) + F.log1p(F.exp(F.least(a, b) - F.greatest(a, b)))


def best_class(log_probs: Column) -> Column:
    """Index of the first greatest entry."""
    return (F.array_position(log_probs, F.array_max(log_probs)) - 1).cast("int")


def paths(logits: DataFrame, line: str = "line_id") -> DataFrame:
    """Per line the best class of each step and its log-probability, as ``raw`` and ``log_prob``, in the order of ``t``."""
    steps = logits.select(line, F.struct("t", best_class(F.col("log_probs")).alias("k"), F.array_max("log_probs").cast("double").alias("p")).alias("s"))
    gathered = steps.groupBy(line).agg(F.array_sort(F.collect_list("s")).alias("s"))
    return gathered.select(line, F.transform("s", lambda x: x["k"]).alias("raw"), F.transform("s", lambda x: x["p"]).alias("log_prob"))


def collapsed(raw: Column, blank: int = 0) -> Column:
    """Class indices without blanks and repeats; a blank between equal classes keeps both."""
    return F.filter(raw, lambda k, i: (k != blank) & ((i == 0) | (F.get(raw, i - 1) != k)))


def spelled(tokens: Column, vocab: list[str]) -> Column:
    letters = F.array(*(F.lit(v) for v in vocab))
    return F.array_join(F.transform(tokens, lambda k: F.get(letters, k)), "")


def greedy(logits: DataFrame, vocab: list[str], blank: int = 0, line: str = "line_id") -> DataFrame:
    """``text``, ``token_indices`` and ``raw_indices`` per line; a line of blanks has the empty text."""
    out = paths(logits, line).select(line, collapsed(F.col("raw"), blank).alias("token_indices"), F.col("raw").alias("raw_indices"))
    return out.select(line, spelled(F.col("token_indices"), vocab).alias("text"), "token_indices", "raw_indices")


HYPOTHESES = "array<struct<text:string,score:double,token_indices:array<int>>>"


def beam(lines: DataFrame, vocab: list[str], blank: int = 0, width: int = 10, most: int = 10, mode: str = "simple", lexicon: dict[str, float] | None = None, alpha: float = 0.0, beta: float = 0.0, line: str = "line_id", errors: bool = False) -> DataFrame:
    """Up to ``most`` hypotheses ``(rank, text, score, token_indices)`` per line of ``(line, log_probs array<array<double>>)``, best first.

    ``mode`` simple keeps one score per prefix, exact is CTC prefix search. The
    search is a sequential program per line, so it runs over Arrow batches;
    ``lexicon`` goes along with it and is meant to be a word list, not a table.
    A line whose matrix is null, ragged or of another width than the vocabulary
    is an error; with ``errors`` it is a row of rank 0 without a text instead,
    and a column ``error`` says why.
    """
    if mode not in ("simple", "exact"):
        raise ValueError(f"unknown mode {mode!r}")
    search = kernels.beam_simple if mode == "simple" else kernels.beam_exact
    bonus = kernels.WordBonus(lexicon, alpha, beta) if lexicon is not None and alpha > 0 else None
    kind = lines.schema[line].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, rows = [], []
            for key, steps in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    found = [(rank, *h, None) for rank, h in enumerate(search(_matrix(steps, vocab), vocab, blank, width, bonus)[:most])]
                except ValueError as e:
                    if not errors:
                        raise
                    found = [(0, None, None, None, str(e))]
                ids += [key] * len(found)
                rows += found
            cols = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int32(), pa.string(), pa.float64(), pa.list_(pa.int32()), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=[line, "rank", "text", "score", "token_indices", "error"])

    out = lines.select(line, "log_probs").mapInArrow(run, f"`{line}` {kind}, rank int, text string, score double, token_indices array<int>, error string")
    return out if errors else out.drop("error")


def _matrix(steps: list[list[float]] | None, vocab: list[str]) -> np.ndarray:
    if not steps or any(s is None or len(s) != len(steps[0]) for s in steps):
        raise ValueError("log_probs must be steps by classes")
    check_vocab(vocab, len(steps[0]))
    return np.array(steps, float)


def matrices(logits: DataFrame, line: str = "line_id") -> DataFrame:
    """Steps of a line as one ``log_probs`` array of arrays, in the order of ``t``."""
    rows = logits.groupBy(line).agg(F.array_sort(F.collect_list(F.struct("t", "log_probs"))).alias("s"))
    return rows.select(line, F.transform("s", lambda x: F.transform(x["log_probs"], lambda v: v.cast("double"))).alias("log_probs"))


def ctc_losses(lines: DataFrame, blank: int = 0, line: str = "line_id") -> DataFrame:
    """``loss`` of each line of ``(line, log_probs, target array<int>)``; zero where the target can't fit into the steps."""
    kind = lines.schema[line].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [kernels.ctc_loss(np.array(s, float), t, blank) for s, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x if np.isfinite(x) else 0.0 for x in found], pa.float64())], names=[line, "loss"])

    return lines.select(line, "log_probs", "target").mapInArrow(run, f"`{line}` {kind}, loss double")


def padded(rows: Column, width: Column | int, fill: Column | float = 0.0) -> Column:
    """An array right-padded to ``width`` entries."""
    width = F.lit(width) if isinstance(width, int) else width
    return F.concat(rows, F.array_repeat(F.lit(fill) if isinstance(fill, float) else fill, F.greatest(width - F.size(rows), F.lit(0))))


def pad_batches(rows: DataFrame, values: str, batch: str, fill: float = 0.0) -> DataFrame:
    """Adds ``padded``: each row's ``values`` right-padded to the widest of its ``batch``. Widths alone are gathered; batches are small groups."""
    widest = rows.groupBy(batch).agg(F.max(F.size(values)).alias("_widest"))
    return rows.join(widest, batch).withColumn("padded", padded(F.col(values), F.col("_widest"), fill)).drop("_widest")
