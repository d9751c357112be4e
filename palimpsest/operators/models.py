"""A table of model versions, and models that each Python process builds once."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "name string, version int, kind string, bytes long, sha256 string, payload binary"
#: A model is sent to every process; a larger one belongs into files that tasks open themselves.
MOST_BYTES = 1 << 28


def _table(spark: SparkSession, path: str) -> DataFrame:
    """The table, or an empty one where nothing has been registered yet."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(SCHEMA).parquet(path) if there else spark.createDataFrame([], SCHEMA)


def register(spark: SparkSession, path: str, name: str, kind: str, payload: bytes) -> int:
    """Adds a version of a model, one above the last, and returns it. Versions are never changed."""
    if len(payload) > MOST_BYTES:
        raise ValueError(f"a model of {len(payload)} bytes is too large to be sent to every process")
    last = _table(spark, path).where(F.col("name") == name).agg(F.max("version")).first()[0] or 0
    row = (name, last + 1, kind, len(payload), hashlib.sha256(payload).hexdigest(), payload)
    spark.createDataFrame([row], SCHEMA).write.mode("append").parquet(path)
    return last + 1


def describe(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """``(name, version, kind, bytes, sha256, latest, error)`` of all versions; a name of ``names`` that has none is a row with ``missing`` as its error."""
    rows = _table(spark, path).drop("payload")
    newest = rows.groupBy("name").agg(F.max("version").alias("_newest"))
    told = rows.join(newest, "name").withColumn("latest", F.col("version") == F.col("_newest")).drop("_newest").withColumn("error", F.lit(None).cast("string"))
    if names is None:
        return told
    asked = spark.createDataFrame([(n,) for n in names], "name string")
    return asked.join(told, "name", "left").withColumn("error", F.when(F.col("version").isNull(), "missing"))


def require(spark: SparkSession, path: str, name: str, version: int | None = None) -> bytes:
    """The bytes of a version, by default the last; FileNotFoundError if there is none."""
    rows = _table(spark, path).where(F.col("name") == name)
    found = (rows.where(F.col("version") == version) if version else rows.orderBy(F.desc("version"))).select("payload").head()
    if found is None:
        raise FileNotFoundError(f"no model {name!r}{f' of version {version}' if version else ''} in {path}")
    return bytes(found[0])


@lru_cache(4)
def _built(build: Callable[[bytes], object], digest: str, payload: _Payload) -> object:
    return build(payload.raw)


class _Payload:
    """Bytes that count as equal to all others: their digest is the cache's key."""

    def __init__(self, raw: bytes):
        self.raw = raw

    def __eq__(self, other: object) -> bool:
        return True

    def __hash__(self) -> int:
        return 0


def applied(spark: SparkSession, payload: bytes, build: Callable[[bytes], Callable[[pd.Series], pd.Series]], returns: str) -> Callable[..., Column]:
    """A column function of a model: each process builds it once, from bytes that are sent once. ``build`` must be a function of a module."""
    sent, digest = spark.sparkContext.broadcast(payload), hashlib.sha256(payload).hexdigest()

    @F.pandas_udf(returns)
    def run(values: pd.Series) -> pd.Series:
        return _built(build, digest, _Payload(sent.value))(values)

    return run


# a model that is trained here: how likely a text's characters are


def train_characters(counts: DataFrame) -> bytes:
    """The model of a table ``(ch, n)``, as lines of code point and count; Unicode bounds its size."""
    rows = counts.select(F.ascii("ch").alias("code"), F.col("n").cast("long").alias("n")).orderBy("code").collect()
    return "\n".join(f"{r.code} {r.n}" for r in rows).encode()


def characters(payload: bytes) -> Callable[[pd.Series], pd.Series]:
    """Mean log-probability of a text's characters, those never seen counted half; null for an empty text."""
    n = {chr(int(c)): int(k) for c, k in (line.split(" ") for line in payload.decode().splitlines())}
    total = sum(n.values())
    logs, unseen = {c: math.log(k / total) for c, k in n.items()}, math.log(0.5 / max(total, 1))
    return lambda texts: texts.map(lambda t: sum(logs.get(c, unseen) for c in t) / len(t) if t else None).astype("float64")
