"""Streams of recognised lines.

Operators that look at one line at a time run on a stream as they are: decoding
of lines that come with all their steps, scoring, flagging by threshold, prompts
and validation without a lexicon. Those that need an order or other lines go
through ``each_batch``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import confidence, decode, gate


def decode_lines(lines: DataFrame, vocab: list[str], blank: int = 0) -> DataFrame:
    """Adds ``text``, ``token_confidence`` and ``sequence_confidence`` to rows with ``log_probs array<array<double>>``; no state, no shuffle."""
    rows = lines.withColumn("raw", F.transform("log_probs", decode.best_class)).withColumn("log_prob", F.transform("log_probs", lambda x: F.array_max(x)))
    rows = rows.withColumn("text", decode.spelled(decode.collapsed(F.col("raw"), blank), vocab)).withColumn("token_confidence", confidence.token_confidence(F.col("raw"), F.col("log_prob"), blank))
    return rows.withColumn("sequence_confidence", confidence.sequence_confidence(F.col("token_confidence"))).drop("raw", "log_prob")


def flag(lines: DataFrame, threshold: float = gate.THRESHOLD) -> DataFrame:
    return gate.gate(lines, threshold)


def gate_counts(flagged: DataFrame, time: str = "ts", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Flagged and accepted lines per window of event time; windows close once the watermark has passed them."""
    return flagged.withWatermark(time, late).groupBy(F.window(time, window), "gate").agg(F.count("*").alias("n"))


def each_batch(lines: DataFrame, work: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> StreamingQuery:
    """Runs ``work`` on each micro-batch and adds its result as Parquet, in a folder per batch, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
