"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import remove, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v): every neighbour in scope points to the least of its hub.

    The least neighbour comes from a group-by, so a hub's edges are combined
    before the shuffle; the join that follows is one that Spark may split when
    a hub holds a large share of the edges.
    """
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("hub"), F.least("m", "u").alias("m"))
    joined = both.join(least, F.col("u") == F.col("hub"))
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("hub").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    """Number and order-free checksum of the edges."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame, src: str, dst: str, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges``; component is the least node reachable.

    Nulls and self-loops make no edge; a node with no other edge is left out.
    Raises when ``max_rounds`` do not suffice (rounds grow with the logarithm
    of a component's size) rather than return components that are not whole.
    """
    now = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where(f"`{src}` is not null and `{dst}` is not null and u <> v").distinct()
    now, path = written(now, "edges")
    seen = _state(now)
    if not seen[0]:
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(max_rounds):
        then, last = path, written(_star(_star(now, large=True), large=False), "edges")
        now, path = last
        remove(edges.sparkSession, then)
        state = _state(now)
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components not stable after {max_rounds} rounds")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(nodes.select(F.col("component").alias("node"), "component").distinct())
