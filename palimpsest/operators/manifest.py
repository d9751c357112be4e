"""Page manifests and line metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import free, stored

REQUIRED = ("source_id", "page_id", "image_path", "dpi", "split")
LINE_FIELDS = ("source_id", "page_id", "line_id", "bbox", "image_path", "transcript")


def page_name(stem: Column, page: Column, suffix: str = "png") -> Column:
    return F.format_string(f"%s_p%04d.{suffix}", stem, page)


def line_name(source: Column, page: Column, line: Column) -> Column:
    return F.format_string("%s_p%04d_l%04d.png", source, page, line)


def page_range(pages: Column, first: int | None = None, last: int | None = None) -> Column:
    """Page numbers to export of a file with ``pages`` pages: inclusive, from zero, clamped; none of an empty file."""
    low = F.greatest(F.lit(first or 0), F.lit(0))
    high = F.least(F.lit(last), pages - 1) if last is not None else pages - 1
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))


def numbered(rows: DataFrame, group: str, order: str, name: str, parts: int | None = None) -> DataFrame:
    """``rows`` with their place (from zero) in the ``order`` of their ``group``, however much of the table one group holds.

    Rows are dealt out by ranges of group and order, as many as Spark's
    shuffle has partitions or ``parts``, and written once; then each range is
    numbered for itself, and starts where the group's earlier ranges end. A null
    is a group, and comes first in the order; equal rows are numbered in any
    order. New columns that the table already has by name get an underscore.
    """
    part, row, start, of, at = free(rows.columns, "part", "row", "start", "of_group", "of_part")
    keys = [F.col(group).asc_nulls_first(), F.col(order).asc_nulls_first(), F.col(part)]
    # equal rows may lie in several ranges: the number that they come with tells them apart
    told = rows.withColumn(part, F.monotonically_increasing_id())
    dealt = told.repartitionByRange(parts, *keys) if parts else told.repartitionByRange(*keys)
    kept = stored(dealt.withColumn(part, F.spark_partition_id()), "ranges")
    sizes = kept.groupBy(F.col(group).alias(of), F.col(part).alias(at)).agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy(of).orderBy(at)) - F.col("size")
    # a group of several ranges fills all but its first and last: there are fewer of these rows than ranges
    starts = sizes.select(of, at, before.alias(start)).where(F.col(start) > 0)
    ranked = kept.withColumn(row, F.row_number().over(Window.partitionBy(group, part).orderBy(F.col(order).asc_nulls_first())))
    met = ranked.join(F.broadcast(starts), F.col(group).eqNullSafe(F.col(of)) & (F.col(part) == F.col(at)), "left")
    return met.withColumn(name, (F.coalesce(start, F.lit(0)) + F.col(row) - 1).cast("int")).drop(part, row, start, of, at)


def build(images: DataFrame, dpi: int = 300, order: str = "image_path") -> DataFrame:
    """One row per ``(source_id, image_path)``, pages numbered from zero in each source by ``order``; split is empty."""
    if dpi <= 0:
        raise ValueError("dpi must be positive")
    kept = [c for c in ("transcript_path",) if c in images.columns]
    placed = numbered(images, "source_id", order, "page_id")
    return placed.select("source_id", "page_id", "image_path", F.lit(dpi).alias("dpi"), F.lit("").alias("split"), *kept)


def zip_transcripts(manifest: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Adds ``transcript_path`` by position within the source; as many are needed as there are pages, checked by an anti join both ways."""
    keys = ["source_id", "page_id"]
    placed = numbered(transcripts, "source_id", "transcript_path", "page_id").select(*keys, "transcript_path")
    odd = manifest.select(*keys, F.lit(1).alias("a")).join(placed.select(*keys, F.lit(1).alias("b")), keys, "full").where("a is null or b is null")
    if not odd.isEmpty():
        raise ValueError("each source needs as many transcripts as images")
    return manifest.join(placed, keys, "left")


def validate(manifest: DataFrame) -> DataFrame:
    missing = [c for c in REQUIRED if c not in manifest.columns]
    if missing:
        raise ValueError(f"manifest lacks columns: {missing}")
    return manifest


def merge(manifests: list[DataFrame]) -> DataFrame:
    """All rows of all manifests, duplicates too; a column that one lacks is null there."""
    if not manifests:
        raise ValueError("no manifests to merge")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [validate(m) for m in manifests])


def line_metadata(records: DataFrame, source_id: Column, page_id: Column) -> DataFrame:
    """Line records with their source and page; a record's own columns win."""
    extra = {k: v for k, v in {"source_id": source_id, "page_id": page_id}.items() if k not in records.columns}
    out = records.withColumns(extra)
    return out.select(*(c for c in LINE_FIELDS if c in out.columns), *(c for c in out.columns if c not in LINE_FIELDS))


def attach_transcripts(lines: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Fills ``transcript`` by (source_id, page_id, line_id); a line without one has the empty text."""
    keys = ["source_id", "page_id", "line_id"]
    text = transcripts.select(*keys, F.col("transcript").alias("found"))
    return lines.drop("transcript").join(text, keys, "left").withColumn("transcript", F.coalesce("found", F.lit(""))).drop("found")
