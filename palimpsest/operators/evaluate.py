"""Corpus evaluation of predictions against references.

Pairs are one table ``(prediction, reference)`` with whatever keys it has, so
texts can't get out of step. Rates are over the whole corpus: errors divided by
the references' length. A rate over no reference text is null.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.strings import _WHITE_CHARS, char_distance, characters, count_of, same_text, strip, tokens, word_errors
from ..session import importable, stored

RARE, TOP = 5, 20
#: Characters of a text up to which its distances are found in batches.
LONG = 512
_TEXTS = ("prediction", "reference")


def paired(predictions: DataFrame, references: DataFrame, keys: list[str]) -> DataFrame:
    """Joins on the keys; a key that only one side has is an error."""
    both = predictions.withColumn("_p", F.lit(1)).join(references.withColumn("_r", F.lit(1)), keys, "full")
    if not both.where("_p is null or _r is null").isEmpty():
        raise ValueError("predictions and references must have the same keys")
    return both.drop("_p", "_r")


def char_errors() -> tuple[Column, Column]:
    p, r = (strip(F.coalesce(c, F.lit(""))) for c in _TEXTS)
    return char_distance(p, r), F.length(r).cast("long")


def word_error_counts() -> tuple[Column, Column]:
    p, r = (tokens(F.col(c)) for c in _TEXTS)
    return word_errors(p, r).cast("long"), F.size(r).cast("long")


def _rate(pairs: DataFrame, counts: tuple[Column, Column], name: str, keys: list[str]) -> DataFrame:
    counted = pairs.select(*keys, counts[0].alias("_errors"), counts[1].alias("_length"))
    sums = counted.groupBy(*keys).agg(F.sum("_errors").alias("errors"), F.sum("_length").alias("length"))
    return sums.withColumn(name, F.try_divide(F.col("errors").cast("double"), F.col("length")))


def cer(pairs: DataFrame, *keys: str) -> DataFrame:
    """``errors``, ``length`` and ``cer``: character edits over reference characters, ends stripped; per ``keys``, if given."""
    return _rate(pairs, char_errors(), "cer", list(keys))


def wer(pairs: DataFrame, *keys: str) -> DataFrame:
    """``errors``, ``length`` and ``wer``: word edits over reference words."""
    return _rate(pairs, word_error_counts(), "wer", list(keys))


def exact_match(pairs: DataFrame) -> DataFrame:
    """Share of pairs equal in normal form C; of none, zero."""
    same = same_text(*(F.coalesce(c, F.lit("")) for c in _TEXTS))
    return pairs.agg(F.coalesce(F.avg(same.cast("double")), F.lit(0.0)).alias("exact_match"), F.count("*").alias("n"))


def char_counts(pairs: DataFrame) -> DataFrame:
    """``(ch, in_reference, tp, fp, fn)`` by bag overlap per line.

    A line's distinct characters are counted where the line is, in both texts
    at once; only sums per character are shuffled.
    """
    p, r = (F.coalesce(c, F.lit("")) for c in _TEXTS)
    rows = pairs.select(p.alias("p"), r.alias("r"), F.explode(F.array_distinct(F.concat(characters(p), characters(r)))).alias("ch"))
    n = rows.select("ch", count_of(F.col("p"), F.col("ch")).alias("np"), count_of(F.col("r"), F.col("ch")).alias("nr"))
    zero = F.lit(0).cast("long")
    return n.groupBy("ch").agg(F.sum("nr").alias("in_reference"), F.sum(F.least("np", "nr")).alias("tp"), F.sum(F.greatest(F.col("np") - F.col("nr"), zero)).alias("fp"), F.sum(F.greatest(F.col("nr") - F.col("np"), zero)).alias("fn"))


def char_frequency(pairs: DataFrame) -> DataFrame:
    return char_counts(pairs).where("in_reference > 0").select("ch", F.col("in_reference").alias("n"))


def rare_characters(pairs: DataFrame, least: int = RARE) -> DataFrame:
    return char_frequency(pairs).where(F.col("n") < least)


def rare_char_metrics(pairs: DataFrame, least: int = RARE) -> DataFrame:
    """Precision, recall and F1 of the characters that references hold fewer than ``least`` times; one in predictions alone isn't reported."""
    return _rare_scores(char_counts(pairs), least)


def _rare_scores(counts: DataFrame, least: int) -> DataFrame:
    share = lambda a, b: F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col(a) + F.col(b)), F.lit(0.0))
    rows = counts.where((F.col("in_reference") > 0) & (F.col("in_reference") < least))
    scored = rows.select("ch", "tp", "fp", "fn", share("tp", "fp").alias("precision"), share("tp", "fn").alias("recall"))
    both = F.col("precision") + F.col("recall")
    return scored.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), both), F.lit(0.0)))


def char_weights(pairs: DataFrame) -> DataFrame:
    """``1 / n`` of each reference character, for weighted training."""
    return char_frequency(pairs).withColumn("weight", 1.0 / F.col("n"))


def substitutions(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, pos, predicted, reference)``: substituted characters of each pair, numbered from the line's end.

    The alignment is a sequential program, so it runs over Arrow batches; the
    distance, which spares most lines the table of costs, comes from the JVM.
    """
    schema = ", ".join(f"`{k}` {pairs.schema[k].dataType.simpleString()}" for k in keys)
    at = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, r, errors = (b.column(at + k).to_pylist() for k in range(3))
            line, pos, x, y = kernels.substitutions(p, r, errors)
            kept = [b.column(c).take(pa.array(line, pa.int64())) for c in range(at)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(pos, pa.int32()), pa.array(x, pa.string()), pa.array(y, pa.string())], names=[*keys, "pos", "predicted", "reference"])

    p, r = (F.coalesce(c, F.lit("")) for c in _TEXTS)
    unlike = pairs.select(*keys, p.alias("p"), r.alias("r")).where("p <> r").select(*keys, "p", "r", F.levenshtein("p", "r").alias("errors"))
    return unlike.mapInArrow(run, f"{schema}, pos int, predicted string, reference string")


def top_confusions(pairs: DataFrame, keys: list[str], top: int = TOP) -> DataFrame:
    """The ``top`` most frequent substitutions; of equals, the one met first in the order of the keys."""
    subs = substitutions(pairs, keys)
    counted = subs.groupBy("predicted", "reference").agg(F.count("*").alias("count"), F.min(F.struct(*keys, "pos")).alias("first"))
    return counted.orderBy(F.desc("count"), "first").limit(top).drop("first")


def source_variance(pairs: DataFrame, source: str = "source_id") -> DataFrame:
    """Number of sources, their mean rate and its population variance; sources without reference text are left out."""
    return cer(pairs, source).where("cer is not null").agg(F.count("*").alias("sources"), F.avg("cer").alias("mean_cer"), F.var_pop("cer").alias("var_cer"))


def decoder_delta(a: DataFrame, b: DataFrame, references: DataFrame, keys: list[str]) -> DataFrame:
    """Both decoders' rates on the same lines, and b's less a's."""
    rates = []
    for name, side in (("a", a), ("b", b)):
        pairs = side.select(*keys, F.col("text").alias("prediction")).join(references, keys)
        (errors, length), (werrors, words) = char_errors(), word_error_counts()
        rates.append(pairs.agg(F.try_divide(F.sum(errors).cast("double"), F.sum(length)).alias("cer"), F.try_divide(F.sum(werrors).cast("double"), F.sum(words)).alias("wer")).withColumn("decoder", F.lit(name)))
    both = rates[0].unionByName(rates[1]).groupBy().pivot("decoder", ["a", "b"]).agg(F.first("cer").alias("cer"), F.first("wer").alias("wer"))
    return both.withColumn("cer_delta", F.col("b_cer") - F.col("a_cer")).withColumn("wer_delta", F.col("b_wer") - F.col("a_wer"))


#: Sums over pairs, of characters, and of substitutions.
_SUMS, _BAGS = ("lines", "errors", "length", "word_errors", "words", "same"), ("in_reference", "tp", "fp", "fn")


def counted(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """What a report counts, in one pass over the pairs: a row of sums, one per character (``ch``) and one per substitution (``predicted``, ``reference``).

    Sums are those of ``cer``, ``wer`` and ``exact_match``; ``in_reference``,
    ``tp``, ``fp`` and ``fn`` those of ``char_counts``; ``count`` and
    ``first`` those of ``top_confusions``. Each batch is counted where it is;
    distances of texts of over ``LONG`` characters come from the JVM.
    """
    at = len(keys)
    kinds = [f"`{k}` {pairs.schema[k].dataType.simpleString()}" for k in keys]
    first = "struct<" + ", ".join(x.replace("` ", "`: ", 1) for x in kinds) + ", pos: int>"
    schema = ", ".join([*(f"{c} long" for c in _SUMS), "ch string", *(f"{c} long" for c in _BAGS), f"predicted string, reference string, count long, first {first}"])
    split = re.compile(f"[{_WHITE_CHARS}]+").split

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            p, r, *known = (b.column(at + k).to_pylist() for k in range(5))
            ends = [(x.strip(_WHITE_CHARS), y.strip(_WHITE_CHARS)) for x, y in zip(p, r, strict=True)]
            unlike = [k for k in range(len(p)) if p[k] != r[k]]
            raw, bare, words = known  # null where the texts are short
            short = [k for k in unlike if raw[k] is None]
            for k, e in zip(short, kernels.edit_distances([p[k] for k in short], [r[k] for k in short]).tolist(), strict=True):
                raw[k] = bare[k] = e
            again = [k for k in short if ends[k] != (p[k], r[k])]
            for k, e in zip(again, kernels.edit_distances(*zip(*(ends[k] for k in again), strict=True)).tolist() if again else [], strict=True):
                bare[k] = e
            parts = [[w for w in split(y) if w] for y in r]
            spelt = [kernels.spelled([w for w in split(p[k]) if w], parts[k]) for k in short]
            for k, e in zip(short, kernels.edit_distances([x for x, _ in spelt], [y for _, y in spelt]).tolist(), strict=True):
                words[k] = e
            odd = sum(not (p[k].isascii() and r[k].isascii()) and unicodedata.normalize("NFC", p[k]) == unicodedata.normalize("NFC", r[k]) for k in unlike)
            sums = [len(p), sum(bare[k] for k in unlike), sum(len(y) for _, y in ends), sum(words[k] for k in unlike), sum(map(len, parts)), len(p) - len(unlike) + odd]
            chars, bags = kernels.shared_counts(p, r)
            order = pc.sort_indices(pa.table(b.columns[:at], names=[f"k{k}" for k in range(at)]), sort_keys=[(f"k{k}", "ascending") for k in range(at)], null_placement="at_start").to_numpy()
            rank = np.empty(len(p), int)
            rank[order] = np.arange(len(p))
            rank = rank[unlike].tolist()
            subs: dict[tuple[str, str], list] = {}
            for line, pos, x, y in zip(*kernels.substitutions([p[k] for k in unlike], [r[k] for k in unlike], [raw[k] for k in unlike]), strict=True):
                place = (rank[line], pos)
                seen = subs.setdefault((x, y), [0, place])
                seen[0] += 1
                if place < seen[1]:
                    seen[1] = place
            n, m = 1 + len(chars), len(subs)
            some = lambda values, before, kind: pa.array([*[None] * before, *values, *[None] * (n + m - before - len(values))], kind)
            line = some([int(order[place[0]]) for _, place in subs.values()], n, pa.int64())
            where = pa.StructArray.from_arrays([*(b.column(c).take(line) for c in range(at)), some([place[1] for _, place in subs.values()], n, pa.int32())], names=[*keys, "pos"], mask=pc.is_null(line))
            cols = [*(some([x], 0, pa.int64()) for x in sums), some(chars, 1, pa.string()), *(some(bags[:, c].tolist(), 1, pa.int64()) for c in range(4)),
                    *(some([x[c] for x in subs], n, pa.string()) for c in range(2)), some([x for x, _ in subs.values()], n, pa.int64()), where]
            yield pa.RecordBatch.from_arrays(cols, names=[*_SUMS, "ch", *_BAGS, "predicted", "reference", "count", "first"])

    importable(pairs.sparkSession)
    p, r = (F.coalesce(c, F.lit("")) for c in _TEXTS)
    far = (p != r) & (F.greatest(F.length(p), F.length(r)) > LONG)
    jvm = [F.when(far, e.cast("long")).alias(f"_e{k}") for k, e in enumerate((F.levenshtein(p, r), char_errors()[0], word_error_counts()[0]))]
    rows = pairs.select(*keys, p.alias("_p"), r.alias("_r"), *jvm).mapInArrow(run, schema)
    return rows.groupBy("ch", "predicted", "reference").agg(*(F.sum(c).alias(c) for c in (*_SUMS, *_BAGS, "count")), F.min("first").alias("first"))


def report(pairs: DataFrame, keys: list[str], checkpoint_id: str, decoder_config: dict, split_id: str, preprocess_config: dict | None = None, lexicon_version: str | None = None, rare: int = RARE, top: int = TOP, found: DataFrame | None = None) -> dict:
    """The benchmark report, of bounded size, from one pass over the pairs; ``found`` is what ``counted`` made of them, if it was stored before."""
    if found is None:
        found = stored(counted(pairs, keys), "counted")
    sums = found.where("lines is not null").select(*_SUMS).first() or [0] * len(_SUMS)
    rate = lambda e, n: e / n if n else None
    confusions = found.where("predicted is not null").orderBy(F.desc("count"), "first").limit(top).select("predicted", "reference", "count")
    return {
        "checkpoint_id": checkpoint_id, "decoder_config": decoder_config, "lexicon_version": lexicon_version, "preprocess_config": preprocess_config or {}, "split_id": split_id,
        "num_lines": sums[0], "timestamp": datetime.now(timezone.utc).isoformat(), "cer": rate(sums[1], sums[2]), "wer": rate(sums[3], sums[4]), "exact_match": rate(sums[5], sums[0]) or 0.0,
        "rare_char_metrics": {r["ch"]: {k: r[k] for k in ("precision", "recall", "f1")} for r in _rare_scores(found.where("ch is not null"), rare).collect()},
        "top_confusions": [r.asDict() | {} for r in confusions.collect()],
    }


def report_name(split_id: str, checkpoint_id: str, at: datetime) -> str:
    return f"benchmark_{split_id}_{checkpoint_id}_{at:%Y%m%dT%H%M%SZ}.json"


def report_frame(spark, found: dict) -> DataFrame:
    """The report as one row of JSON text, non-ASCII as it is, for any writer of text."""
    return spark.createDataFrame([(json.dumps(found, indent=2, ensure_ascii=False),)], "value string")
