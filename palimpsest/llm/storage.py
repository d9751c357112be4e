"""Cutting lineage with tables in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import importable, new_path

__all__ = ["fresh", "importable", "materialize", "new_path", "remove", "small_batches", "written"]


#: Spark's setting for the rows of a batch that goes to Python, its default, and what long texts take.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"


def small_batches(spark: SparkSession) -> None:
    """Send whole texts to Python by fewer rows at a time, unless the session has its own number: batches are held twice, on both sides."""
    key, default, rows = BATCH_ROWS
    if spark.conf.get(key) == default:
        spark.conf.set(key, rows)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``materialize``, and the path of the files."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and go on from the files.

    A lost executor then costs the tasks it ran, not the whole lineage, and a
    result that several branches read is computed once.
    """
    return written(df, name)[0]


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a written table that nothing reads any more."""
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


def fresh(taken: list[str], *names: str) -> list[str]:
    """Names like ``names`` that clash with none in ``taken`` (without regard to case)."""
    used = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out
