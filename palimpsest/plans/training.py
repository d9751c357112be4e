"""Queries on what training takes: sizes, weighted samples, cut transcripts, registered models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.strings import characters
from ..operators import models, splits, training
from ..session import new_path
from . import inputs
from .registry import _SPLIT, query

SAMPLE, SEED = 200, 42
_CHARS = "chars_ AS (SELECT doc_id, line_id, unnest(string_split(transcript, '')) AS ch FROM lines_), counts_ AS (SELECT ch, count(*) AS n FROM chars_ WHERE ch <> '' GROUP BY ch)"


@query(
    "SELECT split, count(*) AS pages, CAST(coalesce(sum(n), 0) AS BIGINT) AS lines, array_to_string(list_sort(list(DISTINCT source_id)), ',') AS sources FROM split_ s LEFT JOIN (SELECT doc_id, count(*) AS n FROM lines_ GROUP BY doc_id) l ON s.image_path = printf('scan_%08d.png', l.doc_id) GROUP BY split",
    inputs.PAGES, _SPLIT, inputs.LINES,
)
def split_lines(spark, sf):
    pages = splits.generate(inputs.pages(spark, sf))
    lines = inputs.lines(spark, sf).select(F.format_string("scan_%08d.png", F.col("doc_id")).alias("image_path"))
    return training.split_lines(pages, lines, ("image_path",)).withColumn("sources", F.array_join("sources", ","))


@query(
    f"""SELECT doc_id, line_id, rarest, round(1.0 / rarest, 12) AS weight FROM (SELECT doc_id, line_id, min(n) AS rarest FROM chars_ JOIN counts_ USING (ch) GROUP BY doc_id, line_id)
 ORDER BY -ln((CAST(concat('0x', substr(md5(concat('{SEED}:', doc_id, ':', line_id)), 1, 13)) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST({1 << 52} AS DOUBLE)) * rarest, doc_id, line_id LIMIT {SAMPLE}""",
    inputs.LINES, _CHARS,
)
def rare_sample(spark, sf):
    """The sampling operator's size is the limit here: so many lines, drawn from all."""
    rows = training.rarity(inputs.lines(spark, sf), ["doc_id", "line_id"])
    return training.weighted_sample(rows, SAMPLE, ["doc_id", "line_id"], seed=SEED).withColumn("weight", F.round("weight", 12))


@query()
def transcript_lines(spark, sf):
    """Whole documents without line breaks, cut by what was recognised of their lines."""
    heard = inputs.pairs(spark, sf).select(F.col("doc_id").alias("page"), "line_id", F.col("prediction").alias("text"))
    texts = inputs.table(spark, sf, "documents").select(F.col("doc_id").alias("page"), F.col("text").alias("transcript"))
    return training.align_transcripts(heard, texts)


def _character_counts(texts):
    return texts.select(F.explode(characters(F.col("text"))).alias("ch")).groupBy("ch").agg(F.count("*").alias("n"))


def _registered(spark, sf) -> tuple[str, bytes]:
    """Two versions of one model: from the benchmark's texts, then from all lines."""
    path = new_path(spark, "models")
    first = _character_counts(inputs.table(spark, sf, "benchmark").select("text"))
    models.register(spark, path, "characters", "counts", models.train_characters(first))
    models.register(spark, path, "characters", "counts", models.train_characters(_character_counts(inputs.lines(spark, sf).select(F.col("transcript").alias("text")))))
    return path, models.require(spark, path, "characters")


_MODELS = """seen_ AS (SELECT 1 AS version, unnest(string_split(text, '')) AS ch FROM benchmark UNION ALL SELECT 2, unnest(string_split(transcript, '')) FROM lines_),
 models_ AS (SELECT version, string_agg(concat(code, ' ', n), chr(10) ORDER BY code) AS payload FROM (SELECT version, unicode(ch) AS code, count(*) AS n FROM seen_ WHERE ch <> '' GROUP BY version, ch) GROUP BY version)"""


@query(
    """SELECT 'characters' AS name, version, 'counts' AS kind, strlen(payload) AS bytes, sha256(payload) AS sha256, version = 2 AS latest, CAST(NULL AS VARCHAR) AS error FROM models_
 UNION ALL SELECT 'ghost', NULL, NULL, NULL, NULL, NULL, 'missing'""",
    inputs.LINES, _MODELS,
)
def model_registry(spark, sf):
    return models.describe(spark, _registered(spark, sf)[0], ["characters", "ghost"])


@query(
    "SELECT doc_id, line_id, round(avg(ln(n / total)), 6) AS score FROM chars_ JOIN (SELECT ch, n, CAST(sum(n) OVER () AS DOUBLE) AS total FROM counts_) USING (ch) GROUP BY doc_id, line_id",
    inputs.LINES, _CHARS,
)
def model_scores(spark, sf):
    """Lines scored by the last version of a registered model, which each process builds once."""
    score = models.applied(spark, _registered(spark, sf)[1], models.characters, "double")
    return inputs.lines(spark, sf).select("doc_id", "line_id", F.round(score("transcript"), 6).alias("score"))
