"""The pipeline's inputs, derived from the test tables; for each the DuckDB SQL that gives the same rows."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import WHITE, tokens
from ..operators import decode, manifest

VOCAB = ["<blank>", " ", *string.ascii_lowercase, *string.ascii_uppercase, *string.digits]
LETTERS = "".join(VOCAB[1:])
STEPS, WRAP = 16, 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("")).alias("source_id"), F.format_string("scan_%08d.png", F.col("doc_id")).alias("image_path"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.build(images(spark, sf_dir))


PAGES = """pages_ AS (SELECT coalesce(source, '') AS source_id, CAST(row_number() OVER (PARTITION BY source ORDER BY printf('scan_%08d.png', doc_id)) - 1 AS INTEGER) AS page_id,
 printf('scan_%08d.png', doc_id) AS image_path, 300 AS dpi, '' AS split FROM documents)"""


def spread(df: DataFrame) -> DataFrame:
    """Deals out an input in fewer partitions than the session has cores, such as one small file; a larger one stays where it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, source_id, line_id, transcript)``: whole documents set in lines of twelve words, white space as one blank."""
    rows = spread(table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("source_id"), "text"))
    rows = rows.select("doc_id", "source_id", tokens(F.col("text")).alias("w"))
    starts = F.when(F.size("w") > 0, F.sequence(F.lit(0), F.floor((F.size("w") - 1) / WRAP).cast("int")))
    return rows.select("doc_id", "source_id", F.explode(F.transform(starts, lambda k: F.struct(k.alias("line_id"), F.array_join(F.slice("w", k * WRAP + 1, WRAP), " ").alias("transcript")))).alias("l")).select("doc_id", "source_id", "l.line_id", "l.transcript")


LINES = f"""words_ AS (SELECT doc_id, source AS source_id, list_filter(regexp_split_to_array(text, '[{WHITE}]+'), lambda x: x <> '') AS w FROM documents),
 lines_ AS (SELECT doc_id, source_id, CAST(k AS INTEGER) AS line_id, array_to_string(w[{WRAP} * k + 1:{WRAP} * k + {WRAP}], ' ') AS transcript FROM words_, unnest(range(0, (len(w) + {WRAP - 1}) // {WRAP})) AS u(k))"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as references; predictions read n for r and the other way round and miss ``the``, but for each fourth document's."""
    spoilt = F.regexp_replace(F.translate("transcript", "nr", "rn"), " the ", " ")
    prediction = F.when(F.col("doc_id") % 4 == 0, F.col("transcript")).otherwise(spoilt)
    return lines(spark, sf_dir).select("doc_id", "source_id", "line_id", prediction.alias("prediction"), F.col("transcript").alias("reference"))


PAIRS = LINES + """,
 pairs_ AS (SELECT doc_id, source_id, line_id, CASE WHEN doc_id % 4 = 0 THEN transcript ELSE regexp_replace(translate(transcript, 'nr', 'rn'), ' the ', ' ', 'g') END AS prediction, transcript AS reference FROM lines_)"""


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as steps of lines, sixteen to a line, as log-probabilities over 64 classes."""
    rows = table(spark, sf_dir, "embeddings")
    return rows.select(F.floor(F.col("vec_id") / STEPS).alias("line_id"), (F.col("vec_id") % STEPS).cast("int").alias("t"), decode.log_softmax(F.col("embedding")).alias("log_probs"))


LOGITS = f"""steps_ AS (SELECT vec_id // {STEPS} AS line_id, CAST(vec_id % {STEPS} AS INTEGER) AS t, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
 logits_ AS (SELECT line_id, t, list_transform(e, lambda x: x - list_max(e) - ln(list_sum(list_transform(e, lambda y: exp(y - list_max(e)))))) AS log_probs,
 CAST(list_position(e, list_max(e)) - 1 AS BIGINT) AS k FROM steps_),
 marked_ AS (SELECT line_id, t, k, log_probs[k + 1] AS p, lag(k) OVER (PARTITION BY line_id ORDER BY t) AS before FROM logits_),
 runs_ AS (SELECT *, sum(CASE WHEN before IS NULL OR before <> k THEN 1 ELSE 0 END) OVER (PARTITION BY line_id ORDER BY t) AS run FROM marked_),
 tokens_ AS (SELECT line_id, run, any_value(k) AS k, exp(max(p)) AS c FROM runs_ WHERE k <> 0 GROUP BY line_id, run),
 scored_ AS (SELECT l.line_id, coalesce(string_agg(substr('{LETTERS}', CAST(k AS INTEGER), 1), '' ORDER BY run), '') AS text, string_agg(CAST(round(c, 6) AS VARCHAR), ',' ORDER BY run) AS token_confidence,
 coalesce(exp(avg(ln(greatest(c, 1e-12)))), 0.0) AS sequence_confidence FROM (SELECT DISTINCT line_id FROM steps_) l LEFT JOIN tokens_ t ON t.line_id = l.line_id GROUP BY l.line_id)"""


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "benchmark").select(F.explode(F.array_remove(F.split(F.lower(F.regexp_replace("text", "[^A-Za-z]+", " ")), " +"), "")).alias("word"))
    return rows.groupBy("word").agg(F.count("*").cast("double").alias("score"))


WORDS = """lexicon_ AS (SELECT word, CAST(count(*) AS DOUBLE) AS score FROM (SELECT unnest(regexp_split_to_array(lower(regexp_replace(text, '[^A-Za-z]+', ' ', 'g')), ' +')) AS word FROM benchmark) WHERE word <> '' GROUP BY word)"""


def outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoder outputs from events: in order of arrival, with a confidence that is missing for errors."""
    rows = table(spark, sf_dir, "events")
    confidence = F.when(F.col("event_type") != "error", F.least(F.col("value") / 100.0, F.lit(1.0)))
    return rows.select(F.col("event_id").alias("ord"), F.col("user_id").alias("page"), F.col("event_type").alias("top1_text"), confidence.alias("sequence_confidence"))


OUTPUTS = """outputs_ AS (SELECT event_id AS ord, user_id AS page, event_type AS top1_text, CASE WHEN event_type <> 'error' THEN least(value / 100.0, 1.0) END AS sequence_confidence FROM events)"""


def audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of all lines, with candidates that reach each check."""
    text = F.col("reference")
    kinds = [F.col("prediction"), F.lit("  "), F.concat_ws(" ", text, text, text), F.concat(text, F.lit("#")), F.lit("xyz abc")]
    candidate = kinds[-1]
    for k, c in enumerate(kinds[:-1]):
        candidate = F.when((F.col("doc_id") + F.col("line_id")) % len(kinds) == k, c).otherwise(candidate)
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("line_id").cast("string"))
    return pairs(spark, sf_dir).select(key.alias("line_id"), text.alias("input_text"), candidate.alias("candidate_text"))


AUDITS = PAIRS + """,
 audits_ AS (SELECT concat(doc_id, ':', line_id) AS line_id, reference AS input_text, CASE (doc_id + line_id) % 5 WHEN 0 THEN prediction WHEN 1 THEN '  ' WHEN 2 THEN concat(reference, ' ', reference, ' ', reference) WHEN 3 THEN concat(reference, '#') ELSE 'xyz abc' END AS candidate_text FROM pairs_)"""


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    width, height = F.col("l_quantity").cast("int"), (F.col("l_linenumber") * 5 + 4).cast("int")
    return rows.select(F.col("l_orderkey").alias("page"), (F.col("l_suppkey") % 500).cast("int").alias("left"), (F.col("l_partkey") % 900).cast("int").alias("top"), width.alias("width"), height.alias("height"), (width * height).alias("area"))


def sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page"), F.lit(600).alias("width"), F.lit(1000).alias("height"))


COMPONENTS = """components_ AS (SELECT l_orderkey AS page, CAST(l_suppkey % 500 AS INTEGER) AS lft, CAST(l_partkey % 900 AS INTEGER) AS top, CAST(l_quantity AS INTEGER) AS width, l_linenumber * 5 + 4 AS height, CAST(l_quantity AS INTEGER) * (l_linenumber * 5 + 4) AS area FROM lineitem),
 kept_ AS (SELECT *, top + height / 2.0 AS cy FROM components_ WHERE width >= 20 AND height >= 10),
 gaps_ AS (SELECT *, CASE WHEN cy - lag(cy) OVER (PARTITION BY page ORDER BY cy) > 2.0 * quantile_cont(height, 0.5) OVER (PARTITION BY page) THEN 1 ELSE 0 END AS fresh FROM kept_),
 clusters_ AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY page ORDER BY cy RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS cluster FROM gaps_)"""


def ink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as inked pixels: a page per user, a row per half hour, a column per second of the minute."""
    at = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("page"), F.floor(at / 1800).cast("int").alias("row"), (at % 60).cast("int").alias("col"))


INK = """ink_ AS (SELECT user_id AS page, CAST(floor((floor(epoch(ts)) - 1704067200) / 1800) AS INTEGER) AS row_, CAST(CAST(floor(epoch(ts)) AS BIGINT) % 60 AS INTEGER) AS col_ FROM events),
 profile_ AS (SELECT page, row_, count(*) AS ink FROM ink_ GROUP BY page, row_),
 breaks_ AS (SELECT page, row_, CASE WHEN row_ - lag(row_) OVER (PARTITION BY page ORDER BY row_) - 1 > 3 THEN 1 ELSE 0 END AS fresh FROM profile_),
 numbered_ AS (SELECT page, row_, CAST(sum(fresh) OVER (PARTITION BY page ORDER BY row_) AS INTEGER) AS band FROM breaks_),
 bands_ AS (SELECT page, band, min(row_) AS start_, max(row_) + 1 AS end_ FROM numbered_ GROUP BY page, band)"""
