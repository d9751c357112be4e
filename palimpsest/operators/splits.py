"""Train, validation and test splits: quotas in an order given by a seeded hash.

Ranks over all rows are found without one task that sees them all: rows fall
into buckets by the first hex digits of their hash, the buckets' counts (4,096
at most) are summed up, and rows are ranked within their bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

DIGITS = 3


def check_ratios(train: float, val: float, test: float) -> None:
    if abs(train + val + test - 1.0) > 1e-6:
        raise ValueError("ratios must add up to 1")
    if not all(0.0 < r < 1.0 for r in (train, val, test)):
        raise ValueError("each ratio must lie between 0 and 1")


def quotas(n: Column, train: float, val: float) -> tuple[Column, Column]:
    """Numbers of training and validation rows of n, half-even rounded, at least one each, so that one is left for test if there is one."""
    t = F.greatest(F.lit(1), F.bround(n * F.lit(train)).cast("long"))
    v = F.greatest(F.lit(1), F.bround(n * F.lit(val)).cast("long"))
    return t, F.when(n - t - v < 1, F.greatest(F.lit(0), n - t - 1)).otherwise(v)


def ranked(rows: DataFrame, seed: int, keys: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 1) in the hash's order and ``n``, the number of rows."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))
    # written, as the sizes and the rows both read it
    placed = stored(rows.withColumn("_digest", digest).withColumn("_bucket", F.substring("_digest", 1, DIGITS)), "ranked")
    sizes = placed.groupBy("_bucket").agg(F.count("*").alias("size"))
    # 16 ** DIGITS rows at most
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = sizes.select("_bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"), F.sum("size").over(every).alias("n"))
    within = Window.partitionBy("_bucket").orderBy("_digest", *keys)
    found = placed.withColumn("_row", F.row_number().over(within)).join(F.broadcast(starts), "_bucket")
    return found.withColumn("rank", F.col("start") + F.col("_row")).drop("_digest", "_bucket", "_row", "start")


def _label(rows: DataFrame, train: float, val: float) -> DataFrame:
    t, v = quotas(F.col("n"), train, val)
    label = F.when(F.col("rank") <= t, "train").when(F.col("rank") <= t + v, "val").otherwise("test")
    return rows.withColumn("split", label).drop("rank", "n")


def generate(manifest: DataFrame, train: float = 0.7, val: float = 0.15, test: float = 0.15, strategy: str = "page", seed: int = 42) -> DataFrame:
    """``manifest`` with ``split``. By ``page`` quotas hold over pages, by ``source`` over sources, each of which stays whole."""
    check_ratios(train, val, test)
    rows = manifest.drop("split")
    if strategy == "page":
        return _label(ranked(rows, seed, ["source_id", "page_id"]), train, val)
    if strategy == "source":
        sources = _label(ranked(rows.select("source_id").distinct(), seed, ["source_id"]), train, val)
        return rows.join(sources, "source_id")
    raise ValueError(f"unknown strategy {strategy!r}")


def split_counts(pages: DataFrame) -> DataFrame:
    """Rows per split and source, with subtotals; a total has ``(all)`` in place of what it sums over."""
    total = lambda c: F.when(F.grouping(c) == 1, "(all)").otherwise(F.col(c))
    return pages.rollup("split", "source_id").agg(total("split").alias("split_"), total("source_id").alias("source_"), F.count("*").alias("n")).select(F.col("split_").alias("split"), F.col("source_").alias("source_id"), "n")


def split_sizes(pages: DataFrame) -> DataFrame:
    """Pages and distinct sources per split."""
    return pages.groupBy("split").agg(F.count("*").alias("pages"), F.count_distinct("source_id").alias("sources"))
