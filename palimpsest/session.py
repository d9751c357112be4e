"""Sessions for this package."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: What the operators rely on; sizes of partitions are the cluster's business.
CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has it, if it isn't installed or sent with --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only a local master may do without one and then gets its own."""
    set_by_cluster = spark.conf.get("spark.checkpoint.dir", None)
    if set_by_cluster:
        return set_by_cluster.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="palimpsest-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return "file://" + _own[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}/{name}"


def free(taken: list[str], *names: str) -> list[str]:
    """Names like ``names`` that none in ``taken`` has, whatever the case."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df``, written once to the shared folder and read from there by all that follows."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark's setting for the rows of a batch that goes to Python, its default, and what images take.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "32"


def long_rows(spark: SparkSession) -> None:
    """Send images to Python by few rows at a time, unless the session has its own number."""
    key, default, rows = BATCH_ROWS
    if spark.conf.get(key) == default:
        spark.conf.set(key, rows)


def session(app: str = "palimpsest", **conf: str) -> SparkSession:
    spark = SparkSession.builder.appName(app).config(map=CONF | conf).getOrCreate()
    importable(spark)
    return spark
