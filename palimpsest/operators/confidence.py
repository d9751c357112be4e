"""Confidence of tokens and of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import decode

FLOOR = 1e-12


def token_confidence(raw: Column, log_prob: Column, blank: int = 0) -> Column:
    """For each run of one class other than blank, the greatest probability of its steps."""
    first = F.filter(F.sequence(F.lit(0), F.size(raw) - 1), lambda i: (i == 0) | (F.get(raw, i) != F.get(raw, i - 1)))
    runs = F.transform(first, lambda s, k: F.struct(s.alias("start"), (F.coalesce(F.get(first, k + 1), F.size(raw)) - s).alias("n")))
    kept = F.filter(runs, lambda r: F.get(raw, r["start"]) != blank)
    some = F.transform(kept, lambda r: F.exp(F.array_max(F.slice(log_prob, r["start"] + 1, r["n"]))))
    return F.when(F.size(raw) > 0, some).otherwise(F.array().cast("array<double>"))


def sequence_confidence(confidences: Column) -> Column:
    """Geometric mean, each value at least 1e-12; of none, zero."""
    logs = F.aggregate(confidences, F.lit(0.0), lambda a, c: a + F.log(F.greatest(c, F.lit(FLOOR))))
    return F.when(F.size(confidences) > 0, F.exp(logs / F.size(confidences))).otherwise(0.0)


def scored(logits: DataFrame, vocab: list[str], blank: int = 0, line: str = "line_id") -> DataFrame:
    """``(line, text, token_confidence, sequence_confidence)`` from one gathering of each line's steps."""
    runs = decode.paths(logits, line).select(line, decode.spelled(decode.collapsed(F.col("raw"), blank), vocab).alias("text"), token_confidence(F.col("raw"), F.col("log_prob"), blank).alias("token_confidence"))
    return runs.select(line, "text", "token_confidence", sequence_confidence(F.col("token_confidence")).alias("sequence_confidence"))
