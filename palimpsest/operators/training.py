"""What training needs from lines: sizes of splits, samples weighted by rare characters, transcripts cut into lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.alignment import cut_texts
from ..functions.strings import characters, tokens
from . import evaluate


#: Bytes of texts that are aligned at once.
TOGETHER = 1 << 25


def by_size(b: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch whose texts, in the third column, have up to ``most`` bytes, or are one."""
    sizes = pc.fill_null(pc.binary_length(b.column(2)), 0).to_numpy(zero_copy_only=False)
    first, total = 0, 0
    for k, n in enumerate(sizes.tolist()):
        if k > first and total + n > most:
            yield b.slice(first, k - first)
            first, total = k, 0
        total += n
    if b.num_rows:
        yield b.slice(first)


def split_lines(pages: DataFrame, lines: DataFrame, keys: tuple[str, ...] = ("source_id", "page_id")) -> DataFrame:
    """``(split, pages, lines, sources)``: pages and lines of each split, and its source ids in order; a page without lines counts.

    Lines are counted per page before they meet the pages.
    """
    counted = lines.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.count("*").alias("_lines"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    met = pages.join(counted, same, "left")
    return met.groupBy("split").agg(F.count("*").alias("pages"), F.coalesce(F.sum("_lines"), F.lit(0)).cast("long").alias("lines"), F.array_sort(F.collect_set("source_id")).alias("sources"))


def rarity(lines: DataFrame, keys: list[str], text: str = "transcript") -> DataFrame:
    """``(keys, rarest, weight)``: how often the rarest character of a line occurs in all of them, and its inverse; lines without a character are left out."""
    counts = evaluate.char_frequency(lines.select(F.lit("").alias("prediction"), F.col(text).alias("reference"))).select("ch", "n")
    each = lines.select(*keys, F.explode(F.array_distinct(characters(F.col(text)))).alias("ch"))
    # as many rows as there are different characters: Unicode bounds them at 1.1 million
    rarest = each.join(F.broadcast(counts), "ch").groupBy(*keys).agg(F.min("n").alias("rarest"))
    return rarest.withColumn("weight", 1.0 / F.col("rarest"))


def chance(seed: int, keys: list[str]) -> Column:
    """A number between 0 and 1, neither included, from a hash of the seed and the keys."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def weighted_sample(rows: DataFrame, n: int, keys: list[str], weight: str = "weight", seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, each draw in proportion to the weights of those left (Efraimidis and Spirakis, 2006).

    The rows with the least exponential keys -ln(u) / weight are such a sample,
    so it is a top-n that tasks find for themselves first. Rows without a
    positive weight are never drawn. ``keys`` must tell rows apart.
    """
    fine = rows.where(F.col(weight) > 0)
    return fine.withColumn("_key", -F.log(chance(seed, keys)) / F.col(weight)).orderBy("_key", *keys).limit(n).drop("_key")


def align_transcripts(lines: DataFrame, texts: DataFrame, page: str = "page", heard: str = "text") -> DataFrame:
    """``(page, line_id, transcript)``: the unlined text of each page cut into its lines by what was recognised of them.

    A page's lines go to its text in one row. White space in the text is one
    blank; a page without a text has null transcripts, a text without lines none.
    """
    kind = lines.schema[page].dataType.simpleString()
    by_page = lines.groupBy(page).agg(F.array_sort(F.collect_list(F.struct(F.col("line_id").cast("long").alias("line_id"), F.array_join(tokens(F.coalesce(F.col(heard), F.lit(""))), " ").alias("heard")))).alias("lines"))
    rows = by_page.join(texts.select(page, F.array_join(tokens(F.col("transcript")), " ").alias("whole")), page, "left").select(page, "lines", "whole")
    # an alignment costs far more than its row's bytes say, so small partitions aren't put together
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), page)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # texts of like sizes are aligned at once: the more there are, the less each costs
            for some in by_size(b, TOGETHER):
                lines, whole = some.column(1).to_pylist(), some.column(2).to_pylist()
                there = [k for k, t in enumerate(whole) if t is not None]
                cut: list[list] = [[None] * len(own) for own in lines]
                for k, parts in zip(there, cut_texts([[x["heard"] for x in lines[k]] for k in there], [whole[k] for k in there]), strict=True):
                    cut[k] = parts
                page_of = pa.array(np.repeat(np.arange(len(lines)), [len(own) for own in lines]))
                yield pa.RecordBatch.from_arrays([some.column(0).take(page_of), pa.array([x["line_id"] for own in lines for x in own], pa.int64()), pa.array([t for own in cut for t in own], pa.string())], names=[page, "line_id", "transcript"])

    return rows.mapInArrow(run, f"`{page}` {kind}, line_id long, transcript string")
