"""Confidence gate: which lines go to correction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.7


def gate(outputs: DataFrame, threshold: float = THRESHOLD, max_flags: int | None = None, order: str = "ord", confidence: str = "sequence_confidence") -> DataFrame:
    """Adds ``gate`` (flagged or accepted) and ``overflow``.

    A line is flagged if its confidence lies below the threshold; a missing one
    counts as 1. With ``max_flags`` only the first so many in ``order`` stay
    flagged: the place of the last of them is a top-N query, and all rows are
    then compared with it where they are. ``order`` must be unique.
    """
    low = F.coalesce(F.col(confidence), F.lit(1.0)) < threshold
    kept = low
    if max_flags is not None:
        first = outputs.where(low).select(order).orderBy(order).limit(max_flags).agg(F.max(order), F.count("*")).first()
        kept = low & (F.col(order) <= first[0]) if first[1] else F.lit(False)
    return outputs.withColumn("gate", F.when(kept, "flagged").otherwise("accepted")).withColumn("overflow", low & ~kept)


def parts(gated: DataFrame, order: str = "ord") -> tuple[DataFrame, DataFrame]:
    """Flagged and accepted rows; to sort the accepted, natural ones go before the overflow, each by ``order``."""
    flagged = gated.where("gate = 'flagged'")
    return flagged, gated.where("gate = 'accepted'").withColumn("rank_key", F.struct("overflow", order))


def invocation_rate(gated: DataFrame) -> DataFrame:
    return gated.agg(F.avg((F.col("gate") == "flagged").cast("double")).alias("invocation_rate"), F.count("*").alias("n"))
