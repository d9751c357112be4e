"""Files: manifests as CSV, lexicons as text, images, logits, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lexicon, manifest

MANIFEST = "source_id string, page_id int, image_path string, dpi int, split string, transcript_path string"


def write_manifest(pages: DataFrame, path: str) -> None:
    pages.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Typed by name, whatever the order of the columns; a missing required column is an error, an empty split is the empty text."""
    raw = spark.read.option("header", True).csv(path)
    manifest.validate(raw)
    types = dict(x.split(" ") for x in MANIFEST.split(", "))
    rows = raw.select(*(F.col(c).cast(types.get(c, "string")).alias(c) for c in raw.columns))
    return rows.fillna("", ["split"])


def read_lexicon(spark: SparkSession, path: str, default: float = 1.0) -> DataFrame:
    """``word [score]`` lines of a file or folder, a large file in as many splits as Spark makes of it.

    Lines are in order of file, then split, then place in it, so that the last
    entry of a word wins.
    """
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("place"))
    return lexicon.from_lines(spark.read.text(path).select(at.alias("line_no"), "value"), default)


def write_lexicon(words: DataFrame, path: str) -> None:
    """Sorted by word, over as many files as the sort has partitions; file names keep the order."""
    words.orderBy("word").select(F.concat_ws(" ", "word", F.col("score").cast("string")).alias("value")).write.mode("overwrite").text(path)


def image_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of the images right in a folder, by suffix, sorted; contents aren't read."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length")
    return files.where(F.regexp_like(F.lower("path"), F.lit("[.](png|jpe?g|tiff?)$"))).orderBy("path")


def read_images(spark: SparkSession, folder: str) -> DataFrame:
    """``(page, image)`` of what decodes as an image; corrupt files are dropped."""
    return spark.read.format("image").option("dropInvalid", True).load(folder).select(F.col("image.origin").alias("page"), "image")


def write_logits(logits: DataFrame, path: str) -> None:
    logits.write.mode("overwrite").partitionBy(*(c for c in ("source_id",) if c in logits.columns)).parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """One JSON document, as it stands in ``value``."""
    report.coalesce(1).write.mode("overwrite").text(path)
