"""Queries by name, and for those that SQL can express the same in DuckDB's."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import stem, tokens
from ..operators import confidence, correct, decode, evaluate, gate, layout, lexicon, manifest, service, splits, validate
from ..session import importable, new_path, stored
from ..sources import files
from . import inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Printable ASCII without # and the letters of Latin-1.
ALLOWED = "".join(chr(c) for c in (*range(32, 127), *range(0xC0, 0x100)) if chr(c) != "#")


def query(sql: str | None = None, *ctes: str):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        @wraps(f)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            importable(spark)
            return f(spark, sf)

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = (f"WITH {', '.join(ctes)} " if ctes else "") + sql
        return run

    return add


# manifests and splits


@query("SELECT * FROM pages_", inputs.PAGES)
def manifest_build(spark, sf):
    return inputs.pages(spark, sf)


@query(
    "SELECT * FROM pages_ UNION ALL BY NAME SELECT 'web' AS source_id, CAST(row_number() OVER (ORDER BY printf('page_%08d.html', page_id)) - 1 AS INTEGER) AS page_id, printf('page_%08d.html', page_id) AS image_path, 150 AS dpi, '' AS split FROM pages",
    inputs.PAGES,
)
def manifest_merge(spark, sf):
    web = inputs.table(spark, sf, "pages").select(F.lit("web").alias("source_id"), F.format_string("page_%08d.html", F.col("page_id")).alias("image_path"))
    return manifest.merge([inputs.pages(spark, sf), manifest.build(web, dpi=150)])


_QUOTAS = "greatest(1, CAST(round_even(n * CAST(0.7 AS DOUBLE), 0) AS BIGINT)) AS tr, greatest(1, CAST(round_even(n * CAST(0.15 AS DOUBLE), 0) AS BIGINT)) AS va0"
_LABEL = "CASE WHEN rank <= tr THEN 'train' WHEN rank <= tr + va THEN 'val' ELSE 'test' END AS split"
_SPLIT = f"""ranked_ AS (SELECT * EXCLUDE (split), row_number() OVER (ORDER BY md5(concat('42:', source_id, ':', page_id)), source_id, page_id) AS rank, count(*) OVER () AS n FROM pages_),
 quota_ AS (SELECT *, CASE WHEN n - tr - va0 < 1 THEN greatest(0, n - tr - 1) ELSE va0 END AS va FROM (SELECT *, {_QUOTAS} FROM ranked_)),
 split_ AS (SELECT * EXCLUDE (rank, n, tr, va0, va), {_LABEL} FROM quota_)"""


@query("SELECT * FROM split_", inputs.PAGES, _SPLIT)
def split_page(spark, sf):
    return splits.generate(inputs.pages(spark, sf), strategy="page")


@query(
    f"""SELECT p.* EXCLUDE (split), s.split FROM pages_ p JOIN (SELECT source_id, {_LABEL} FROM (SELECT *, CASE WHEN n - tr - va0 < 1 THEN greatest(0, n - tr - 1) ELSE va0 END AS va FROM (SELECT *, {_QUOTAS} FROM
 (SELECT source_id, row_number() OVER (ORDER BY md5(concat('42:', source_id)), source_id) AS rank, count(*) OVER () AS n FROM (SELECT DISTINCT source_id FROM pages_))))) s USING (source_id)""",
    inputs.PAGES,
)
def split_source(spark, sf):
    return splits.generate(inputs.pages(spark, sf), strategy="source")


@query("SELECT CASE WHEN grouping(split) = 1 THEN '(all)' ELSE split END AS split, CASE WHEN grouping(source_id) = 1 THEN '(all)' ELSE source_id END AS source_id, count(*) AS n FROM split_ GROUP BY ROLLUP (split, source_id)", inputs.PAGES, _SPLIT)
def split_counts(spark, sf):
    return splits.split_counts(splits.generate(inputs.pages(spark, sf)))


@query("SELECT split, count(*) AS pages, count(DISTINCT source_id) AS sources FROM split_ GROUP BY split", inputs.PAGES, _SPLIT)
def split_sizes(spark, sf):
    return splits.split_sizes(splits.generate(inputs.pages(spark, sf)))


@query("SELECT l.source_id, page_id, line_id, transcript FROM lines_ l JOIN (SELECT *, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS INTEGER) AS page_id FROM documents) d USING (doc_id)", inputs.LINES)
def transcript_align(spark, sf):
    pages = inputs.pages(spark, sf).select("source_id", "page_id", F.regexp_extract("image_path", "([0-9]+)[.]png$", 1).cast("long").alias("doc_id"))
    texts = inputs.lines(spark, sf).drop("source_id").join(pages, "doc_id")
    bare = texts.select("source_id", "page_id", "line_id", F.lit("").alias("transcript"))
    return manifest.attach_transcripts(bare, texts)


@query("SELECT source_id, doc_id AS page_id, line_id, concat(coalesce(source_id, ''), printf('_p%04d_l%04d.png', doc_id, line_id)) AS image_path, concat('0,', 20 * line_id, ',600,18') AS bbox, transcript FROM lines_", inputs.LINES)
def line_metadata(spark, sf):
    rows = inputs.lines(spark, sf).withColumn("bbox", F.array(F.lit(0), F.col("line_id") * 20, F.lit(600), F.lit(18)))
    rows = rows.withColumn("image_path", manifest.line_name(F.coalesce("source_id", F.lit("")), F.col("doc_id"), F.col("line_id")))
    out = manifest.line_metadata(rows, F.col("source_id"), F.col("doc_id"))  # a record's own source wins
    return out.select("source_id", "page_id", "line_id", "image_path", F.array_join("bbox", ",").alias("bbox"), "transcript")


# decoding


@query("SELECT line_id, t, k FROM logits_", inputs.LOGITS)
def argmax_steps(spark, sf):
    return inputs.logits(spark, sf).select("line_id", "t", decode.best_class(F.col("log_probs")).cast("long").alias("k"))


@query("SELECT line_id, t, CAST(c - 1 AS INTEGER) AS c, round(log_probs[c], 6) AS log_prob FROM logits_, unnest(range(1, 65)) AS u(c)", inputs.LOGITS)
def log_softmax(spark, sf):
    return inputs.logits(spark, sf).select("line_id", "t", F.posexplode("log_probs").alias("c", "log_prob")).withColumn("log_prob", F.round("log_prob", 6))


@query("SELECT line_id, t, round(greatest(a, b) + ln(1 + exp(least(a, b) - greatest(a, b))), 6) AS lse FROM (SELECT line_id, t, log_probs[1] AS a, log_probs[2] AS b FROM logits_)", inputs.LOGITS)
def log_sum_exp(spark, sf):
    return inputs.logits(spark, sf).select("line_id", "t", F.round(decode.log_sum_exp(F.get("log_probs", 0), F.get("log_probs", 1)), 6).alias("lse"))


@query("SELECT line_id, text FROM scored_", inputs.LOGITS)
def greedy_decode(spark, sf):
    return decode.greedy(inputs.logits(spark, sf), inputs.VOCAB).select("line_id", "text")


@query("SELECT line_id, token_no, confidence FROM (SELECT line_id, CAST(row_number() OVER (PARTITION BY line_id ORDER BY run) - 1 AS INTEGER) AS token_no, round(c, 6) AS confidence FROM tokens_)", inputs.LOGITS)
def token_confidence(spark, sf):
    rows = confidence.scored(inputs.logits(spark, sf), inputs.VOCAB)
    return rows.select("line_id", F.posexplode("token_confidence").alias("token_no", "confidence")).withColumn("confidence", F.round("confidence", 6))


@query("SELECT line_id, text, round(sequence_confidence, 6) AS sequence_confidence FROM scored_", inputs.LOGITS)
def sequence_confidence(spark, sf):
    return confidence.scored(inputs.logits(spark, sf), inputs.VOCAB).select("line_id", "text", F.round("sequence_confidence", 6).alias("sequence_confidence"))


def _beam(spark, sf, mode, **more):
    lines = decode.matrices(inputs.logits(spark, sf))
    return decode.beam(lines, inputs.VOCAB, mode=mode, **more).select("line_id", "rank", "text", F.round("score", 6).alias("score"), F.array_join("token_indices", ",").alias("token_indices"))


# Each step of the search: every beam meets every class in order of arrival (the blank first), prefixes that arrive more than once are summed up.
_SIMPLE = """search_ AS (SELECT line_id, -1 AS t, CAST([] AS INTEGER[]) AS key, CAST(0 AS DOUBLE) AS score, -1 AS last, false AS ended, CAST(1 AS BIGINT) AS r FROM (SELECT DISTINCT line_id FROM steps_) UNION ALL
 SELECT line_id, t, key, score, last, ended, r FROM (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY score DESC, arrival) AS r FROM (SELECT line_id, t, key, max(s) + ln(sum(exp(s - top))) AS score, arg_min(last, arrival) AS last, arg_min(ended, arrival) AS ended, min(arrival) AS arrival
 FROM (SELECT *, max(s) OVER (PARTITION BY line_id, key) AS top FROM (SELECT b.line_id, b.t + 1 AS t, CASE WHEN c = 0 OR c = last AND NOT ended THEN key ELSE list_append(key, c) END AS key, score + log_probs[c + 1] AS s, CASE WHEN c = 0 THEN last ELSE c END AS last, c = 0 AS ended, r * 64 + c AS arrival
 FROM search_ b JOIN logits_ l ON l.line_id = b.line_id AND l.t = b.t + 1, (SELECT CAST(c AS INTEGER) AS c FROM range(64) AS u(c)))) GROUP BY line_id, t, key)) WHERE r <= 10)"""
_EXACT = """search_ AS (SELECT line_id, -1 AS t, CAST([] AS INTEGER[]) AS key, CAST(0 AS DOUBLE) AS b, CAST(-1e30 AS DOUBLE) AS nb, CAST(0 AS DOUBLE) AS score, CAST(1 AS BIGINT) AS r FROM (SELECT DISTINCT line_id FROM steps_) UNION ALL
 SELECT line_id, t, key, b, nb, score, r FROM (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY score DESC, arrival) AS r FROM (SELECT *, greatest(b, nb) + ln(exp(b - greatest(b, nb)) + exp(nb - greatest(b, nb))) AS score FROM (SELECT line_id, t, key, max(b) + ln(sum(exp(b - top_b))) AS b, max(nb) + ln(sum(exp(nb - top_nb))) AS nb, min(arrival) AS arrival
 FROM (SELECT *, max(b) OVER (PARTITION BY line_id, key) AS top_b, max(nb) OVER (PARTITION BY line_id, key) AS top_nb FROM (SELECT s.line_id, s.t + 1 AS t, CASE WHEN c = 0 THEN key ELSE list_append(key, c) END AS key, CASE WHEN c = 0 THEN score + log_probs[1] ELSE -1e30 END AS b,
 CASE WHEN c = 0 THEN CASE WHEN len(key) > 0 THEN nb + log_probs[key[-1] + 1] ELSE -1e30 END WHEN len(key) > 0 AND c = key[-1] THEN b + log_probs[c + 1] ELSE score + log_probs[c + 1] END AS nb, r * 64 + c AS arrival
 FROM search_ s JOIN logits_ l ON l.line_id = s.line_id AND l.t = s.t + 1, (SELECT CAST(c AS INTEGER) AS c FROM range(64) AS u(c)))) GROUP BY line_id, t, key)) WHERE greatest(b, nb) > -1e29) WHERE r <= 10)"""
_SPELLED = f"""spelled_ AS (SELECT line_id, CAST(r - 1 AS INTEGER) AS rank, array_to_string(list_transform(key, lambda k: substr('{inputs.LETTERS}', k, 1)), '') AS text, score, key FROM search_ QUALIFY t = max(t) OVER (PARTITION BY line_id))"""
_HYPOTHESES = "SELECT line_id, rank, text, round(score, 6) AS score, array_to_string(key, ',') AS token_indices FROM spelled_"


@query(_HYPOTHESES, "RECURSIVE " + inputs.LOGITS, _SIMPLE, _SPELLED)
def beam_decode(spark, sf):
    return _beam(spark, sf, "simple")


@query(_HYPOTHESES, "RECURSIVE " + inputs.LOGITS, _EXACT, _SPELLED)
def beam_decode_exact(spark, sf):
    return _beam(spark, sf, "exact")


_THREE = "greatest(a[i], x, y) + ln(exp(a[i] - greatest(a[i], x, y)) + exp(x - greatest(a[i], x, y)) + exp(y - greatest(a[i], x, y)))"


@query(
    "SELECT line_id, round(CASE WHEN p > -1e29 THEN -p ELSE 0.0 END, 6) AS loss FROM (SELECT line_id, CASE WHEN len(a) = 1 THEN a[1] ELSE greatest(a[-1], a[-2]) + ln(exp(a[-1] - greatest(a[-1], a[-2])) + exp(a[-2] - greatest(a[-1], a[-2]))) END AS p FROM alpha_ QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY t DESC) = 1)",
    "RECURSIVE " + inputs.LOGITS,
    "states_ AS (SELECT l.line_id, list_append(flatten(coalesce(list([0, CAST(k AS INTEGER)] ORDER BY run) FILTER (k IS NOT NULL), CAST([] AS INTEGER[][]))), 0) AS s FROM (SELECT DISTINCT line_id FROM steps_) l LEFT JOIN tokens_ t ON t.line_id = l.line_id GROUP BY l.line_id)",
    f"""alpha_ AS (SELECT line_id, 0 AS t, list_transform(range(1, len(s) + 1), lambda i: CASE WHEN i <= 2 THEN log_probs[s[i] + 1] ELSE CAST(-1e30 AS DOUBLE) END) AS a FROM states_ JOIN logits_ USING (line_id) WHERE t = 0 UNION ALL
 SELECT line_id, t, list_transform(range(1, len(s) + 1), lambda i: log_probs[s[i] + 1] + list_transform([{{'x': CASE WHEN i > 1 THEN a[i - 1] ELSE -1e30 END, 'y': CASE WHEN i > 2 AND s[i] <> 0 AND s[i] <> s[i - 2] THEN a[i - 2] ELSE -1e30 END}}], lambda o: {_THREE.replace("x)", "o.x)").replace("x,", "o.x,").replace("exp(x", "exp(o.x").replace("y)", "o.y)").replace("y,", "o.y,").replace("exp(y", "exp(o.y")})[1]) AS a
 FROM (SELECT p.line_id, p.t + 1 AS t, a, s, log_probs FROM alpha_ p JOIN states_ USING (line_id) JOIN logits_ l ON l.line_id = p.line_id AND l.t = p.t + 1))""",
)
def ctc_loss(spark, sf):
    lines = decode.matrices(inputs.logits(spark, sf))
    targets = decode.greedy(inputs.logits(spark, sf), inputs.VOCAB).select("line_id", F.col("token_indices").alias("target"))
    return decode.ctc_losses(lines.join(targets, "line_id")).withColumn("loss", F.round("loss", 6))


# lexicon


@query("SELECT word, score FROM lexicon_", inputs.WORDS)
def lexicon_build(spark, sf):
    entries = inputs.words(spark, sf).select(F.lit(1).alias("line_no"), F.concat_ws(" ", "word", F.col("score").cast("string")).alias("value"))
    return lexicon.from_lines(entries)


_SPOKEN = "spoken_ AS (SELECT doc_id, line_id, unnest(string_split(transcript, ' ')) AS word FROM lines_)"


def _spoken(spark, sf):
    return inputs.lines(spark, sf).select("doc_id", "line_id", F.explode(tokens(F.col("transcript"))).alias("word"))


@query("SELECT s.word, count(*) AS n, coalesce(any_value(l.score), 0.0) AS score, any_value(l.word) IS NOT NULL AS hit FROM spoken_ s LEFT JOIN lexicon_ l USING (word) GROUP BY s.word", inputs.LINES, inputs.WORDS, _SPOKEN)
def lexicon_lookup(spark, sf):
    counted = _spoken(spark, sf).groupBy("word").agg(F.count("*").alias("n"))
    return lexicon.scores(counted, inputs.words(spark, sf))


@query("SELECT count(*) AS words, count(l.word) AS hits, round(count(l.word) / CAST(count(*) AS DOUBLE), 6) AS hit_rate FROM spoken_ s LEFT JOIN lexicon_ l USING (word)", inputs.LINES, inputs.WORDS, _SPOKEN)
def lexicon_hit_rate(spark, sf):
    counted = _spoken(spark, sf).groupBy("word").agg(F.count("*").alias("n"))
    hits = F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0))
    return lexicon.scores(counted, inputs.words(spark, sf)).agg(F.sum("n").alias("words"), hits.alias("hits"), F.round(hits / F.sum("n"), 6).alias("hit_rate"))


@query(
    "SELECT doc_id, line_id, round(coalesce(0.5 * ln(score + 1e-10) + 0.25, 0.0), 6) AS bonus FROM lines_ LEFT JOIN lexicon_ ON word = string_split(transcript, ' ')[-1]",
    inputs.LINES, inputs.WORDS,
)
def lexicon_score(spark, sf):
    rows = inputs.lines(spark, sf).select("doc_id", "line_id", F.concat("transcript", F.lit(" ")).alias("text"))
    return lexicon.boundary_score(rows, inputs.words(spark, sf), 0.5, 0.25).select("doc_id", "line_id", F.round("bonus", 6).alias("bonus"))


# gate, correction, validation

_LOW = "coalesce(sequence_confidence, 1.0) < 0.7"


@query(f"SELECT line_id, text, CASE WHEN sequence_confidence < 0.025 THEN 'flagged' ELSE 'accepted' END AS gate FROM scored_", inputs.LOGITS)
def gate_lines(spark, sf):
    rows = confidence.scored(inputs.logits(spark, sf), inputs.VOCAB)
    return gate.gate(rows, 0.025, order="line_id").select("line_id", "text", "gate")


QUERIES["gate"] = QUERIES.pop("gate_lines")
SQL["gate"] = SQL.pop("gate_lines")


@query(f"SELECT ord, CASE WHEN {_LOW} AND r <= 500 THEN 'flagged' ELSE 'accepted' END AS gate, {_LOW} AND r > 500 AS overflow FROM (SELECT *, row_number() OVER (PARTITION BY {_LOW} ORDER BY ord) AS r FROM outputs_)", inputs.OUTPUTS)
def gate_capped(spark, sf):
    return gate.gate(inputs.outputs(spark, sf), max_flags=500).select("ord", "gate", "overflow")


@query(f"SELECT round(avg(CASE WHEN {_LOW} THEN 1.0 ELSE 0.0 END), 6) AS invocation_rate, count(*) AS n FROM outputs_", inputs.OUTPUTS)
def invocation_rate(spark, sf):
    return gate.invocation_rate(gate.gate(inputs.outputs(spark, sf))).withColumn("invocation_rate", F.round("invocation_rate", 6))


_PROMPT = f"concat('{correct.LEAD}{correct.FIELD}', prediction, chr(10), '{correct.ALTERNATIVES}', CASE WHEN prediction <> reference THEN reference ELSE '(none)' END, chr(10), chr(10), '{correct.TAIL}')"


def _readings():
    return F.when(F.col("prediction") != F.col("reference"), F.array("prediction", "reference")).otherwise(F.array("prediction"))


@query(f"SELECT doc_id, line_id, md5({_PROMPT}) AS prompt_md5, length({_PROMPT}) AS prompt_length FROM pairs_", inputs.PAIRS)
def prompt_build(spark, sf):
    text = correct.prompt(F.col("prediction"), _readings())
    return inputs.pairs(spark, sf).select("doc_id", "line_id", F.md5(text).alias("prompt_md5"), F.length(text).cast("long").alias("prompt_length"))


@query(f"SELECT concat(doc_id, ':', line_id) AS line_id, prediction AS input_text, trim(prediction) AS candidate_text, 'pending' AS decision FROM pairs_", inputs.PAIRS)
def correction_request(spark, sf):
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("line_id").cast("string"))
    rows = inputs.pairs(spark, sf).select(key.alias("line_id"), F.col("prediction").alias("text"), _readings().alias("nbest"))
    return correct.request(rows, correct.EchoClient()).select("line_id", "input_text", "candidate_text", "decision")


_VALIDATED = """hits_ AS (SELECT a.line_id, bool_or(side = 0) AS oh, bool_or(side = 1) AS ch FROM (SELECT line_id, 0 AS side, unnest(regexp_split_to_array(input_text, ' +')) AS word FROM audits_ UNION ALL SELECT line_id, 1, unnest(regexp_split_to_array(candidate_text, ' +')) FROM audits_) a JOIN lexicon_ USING (word) GROUP BY a.line_id),
 ratios_ AS (SELECT *, greatest(length(candidate_text), 1) / CAST(greatest(length(input_text), 1) AS DOUBLE) AS ratio FROM audits_),
 validated_ AS (SELECT r.line_id, ratio, CASE WHEN trim(candidate_text) = '' THEN 'empty' WHEN ratio > 2.0 OR ratio < 0.5 THEN 'length_ratio' WHEN regexp_matches(candidate_text, '[^ -"$-~À-ÿ]') THEN 'characters' WHEN coalesce(oh, false) AND NOT coalesce(ch, false) THEN 'lexicon' END AS reason_code FROM ratios_ r LEFT JOIN hits_ h ON h.line_id = r.line_id)"""
_AUDIT = (inputs.AUDITS, inputs.WORDS, _VALIDATED)


def _validated(spark, sf):
    return validate.validate(inputs.audits(spark, sf), ALLOWED, lexicon=inputs.words(spark, sf))


@query("SELECT line_id, CASE WHEN reason_code IS NULL THEN 'accepted' ELSE 'rejected' END AS decision, reason_code, round(ratio, 6) AS length_ratio FROM validated_", *_AUDIT)
def validate_corrections(spark, sf):
    return _validated(spark, sf).select("line_id", "decision", "reason_code", F.round("length_ratio", 6).alias("length_ratio"))


@query("SELECT reason_code, count(*) AS n FROM validated_ WHERE reason_code IS NOT NULL GROUP BY reason_code", *_AUDIT)
def reject_reasons(spark, sf):
    return validate.reject_reasons(_validated(spark, sf))


@query("SELECT round(avg(CASE WHEN reason_code IS NULL THEN 1.0 ELSE 0.0 END), 6) AS acceptance_rate, count(*) AS n FROM validated_", *_AUDIT)
def acceptance_rate(spark, sf):
    return validate.acceptance_rate(_validated(spark, sf)).withColumn("acceptance_rate", F.round("acceptance_rate", 6))


# evaluation

# DuckDB's levenshtein counts bytes, so where a pair isn't ASCII each of its characters becomes one byte
_BYTES = lambda x: f"array_to_string(list_transform(string_split({x}, ''), lambda c: chr(CAST(list_position(v, c) AS INTEGER))), '')"
_DISTANCE = f"""distances_ AS (SELECT *, CASE WHEN regexp_full_match(concat(p, r), '[\\x01-\\x7F]*') THEN levenshtein(p, r) ELSE levenshtein({_BYTES("p")}, {_BYTES("r")}) END AS e FROM
 (SELECT doc_id, source_id, line_id, trim(prediction) AS p, trim(reference) AS r, list_distinct(list_concat(string_split(trim(prediction), ''), string_split(trim(reference), ''))) AS v FROM pairs_))"""
_CER = "sum(e)"
_WER = """errors_ AS (SELECT *, len(r) AS n, levenshtein(array_to_string(list_transform(p, lambda w: chr(CAST(33 + list_position(v, w) AS INTEGER))), ''), array_to_string(list_transform(r, lambda w: chr(CAST(33 + list_position(v, w) AS INTEGER))), '')) AS e
 FROM (SELECT *, list_distinct(list_concat(p, r)) AS v FROM (SELECT doc_id, source_id, line_id, list_filter(string_split(prediction, ' '), lambda x: x <> '') AS p, string_split(reference, ' ') AS r FROM pairs_)))"""


@query(f"SELECT CAST({_CER} AS BIGINT) AS errors, CAST(sum(length(r)) AS BIGINT) AS length, round({_CER} / CAST(sum(length(r)) AS DOUBLE), 6) AS cer FROM distances_", inputs.PAIRS, _DISTANCE)
def cer(spark, sf):
    return evaluate.cer(inputs.pairs(spark, sf)).withColumn("cer", F.round("cer", 6))


@query("SELECT CAST(sum(e) AS BIGINT) AS errors, CAST(sum(n) AS BIGINT) AS length, round(sum(e) / CAST(sum(n) AS DOUBLE), 6) AS wer FROM errors_", inputs.PAIRS, _WER)
def wer(spark, sf):
    return evaluate.wer(inputs.pairs(spark, sf)).withColumn("wer", F.round("wer", 6))


@query("SELECT round(coalesce(avg(CASE WHEN nfc_normalize(prediction) = nfc_normalize(reference) THEN 1.0 ELSE 0.0 END), 0.0), 6) AS exact_match, count(*) AS n FROM pairs_", inputs.PAIRS)
def exact_match(spark, sf):
    return evaluate.exact_match(inputs.pairs(spark, sf)).withColumn("exact_match", F.round("exact_match", 6))


@query(f"SELECT source_id, CAST({_CER} AS BIGINT) AS errors, CAST(sum(length(r)) AS BIGINT) AS length, round({_CER} / CAST(sum(length(r)) AS DOUBLE), 6) AS cer FROM distances_ GROUP BY source_id", inputs.PAIRS, _DISTANCE)
def cer_by_source(spark, sf):
    return evaluate.cer(inputs.pairs(spark, sf), "source_id").withColumn("cer", F.round("cer", 6))


@query(f"SELECT count(*) AS sources, round(avg(c), 6) AS mean_cer, round(var_pop(c), 9) AS var_cer FROM (SELECT {_CER} / CAST(sum(length(r)) AS DOUBLE) AS c FROM distances_ GROUP BY source_id)", inputs.PAIRS, _DISTANCE)
def cer_variance(spark, sf):
    return evaluate.source_variance(inputs.pairs(spark, sf)).select("sources", F.round("mean_cer", 6).alias("mean_cer"), F.round("var_cer", 9).alias("var_cer"))


_CHARS = """p_ AS (SELECT doc_id, line_id, ch, count(*) AS n FROM (SELECT doc_id, line_id, unnest(string_split(prediction, '')) AS ch FROM pairs_) GROUP BY ALL),
 r_ AS (SELECT doc_id, line_id, ch, count(*) AS n FROM (SELECT doc_id, line_id, unnest(string_split(reference, '')) AS ch FROM pairs_) GROUP BY ALL),
 bags_ AS (SELECT ch, CAST(sum(coalesce(r_.n, 0)) AS BIGINT) AS in_reference, CAST(sum(least(coalesce(p_.n, 0), coalesce(r_.n, 0))) AS BIGINT) AS tp, CAST(sum(greatest(0, coalesce(p_.n, 0) - coalesce(r_.n, 0))) AS BIGINT) AS fp,
 CAST(sum(greatest(0, coalesce(r_.n, 0) - coalesce(p_.n, 0))) AS BIGINT) AS fn FROM p_ FULL JOIN r_ USING (doc_id, line_id, ch) WHERE ch <> '' GROUP BY ch)"""


@query("SELECT ch, in_reference AS n FROM bags_ WHERE in_reference > 0", inputs.PAIRS, _CHARS)
def char_frequency(spark, sf):
    return evaluate.char_frequency(inputs.pairs(spark, sf))


@query("SELECT ch, in_reference AS n FROM bags_ WHERE in_reference > 0 AND in_reference < 200", inputs.PAIRS, _CHARS)
def rare_characters(spark, sf):
    return evaluate.rare_characters(inputs.pairs(spark, sf), 200)


_PRF = "SELECT ch, tp, fp, fn, CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0.0 END AS p, CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0.0 END AS r FROM bags_ WHERE in_reference > 0 AND in_reference < 1000000000"


@query(f"SELECT ch, tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6) AS f1 FROM ({_PRF})", inputs.PAIRS, _CHARS)
def char_prf(spark, sf):
    rows = evaluate.rare_char_metrics(inputs.pairs(spark, sf), 1_000_000_000)
    return rows.select("ch", "tp", "fp", "fn", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


@query("SELECT ch, in_reference AS n, round(1.0 / in_reference, 12) AS weight FROM bags_ WHERE in_reference > 0", inputs.PAIRS, _CHARS)
def char_weights(spark, sf):
    return evaluate.char_weights(inputs.pairs(spark, sf)).withColumn("weight", F.round("weight", 12))


# Of one length and as many places apart as the distance says, two lines have no other way than place by place. Of the rest, without their common ends,
# the tables are filled by anti-diagonals, no farther from the middle than the distance, and the cells carry the substituted characters of their way:
# a match goes first, then a substitution, then a dropped character.
_FAR = "{'c': 1000000, 's': ''}"
_CELL = f"""CASE WHEN d - i < 0 OR d - i > len(rc) OR abs(d - 2 * i) > e THEN {_FAR} WHEN i = 0 OR i = d THEN {{'c': CAST(d AS INTEGER), 's': ''}} WHEN pc[i] = rc[d - i] THEN before[i]
 WHEN before[i].c <= least(last[i].c, last[i + 1].c) THEN {{'c': before[i].c + 1, 's': concat(before[i].s, pc[i], rc[d - i])}} WHEN last[i].c <= last[i + 1].c THEN {{'c': last[i].c + 1, 's': last[i].s}} ELSE {{'c': last[i + 1].c + 1, 's': last[i + 1].s}} END"""
_NONE = f"list_transform(range(0, len(pc) + 1), lambda i: CASE WHEN i = 0 THEN {{'c': 0, 's': ''}} ELSE {_FAR} END)"
_CONFUSED = f"""unlike_ AS (SELECT *, list_sum(list_transform(range(1, least(len(pc), len(rc)) + 1), lambda i: CAST(pc[i] <> rc[i] AS INTEGER))) AS apart FROM (SELECT doc_id, line_id, e, string_split(p, '') AS pc, string_split(r, '') AS rc FROM distances_ WHERE p <> r AND p <> '' AND r <> '')),
 bare_ AS (SELECT doc_id, line_id, e, pc[h + 1:len(pc) - t] AS pc, rc[h + 1:len(rc) - t] AS rc FROM (SELECT *, coalesce(list_position(list_transform(range(1, least(len(pc), len(rc)) - h + 1), lambda i: pc[-i] <> rc[-i]), true) - 1, least(len(pc), len(rc)) - h) AS t
 FROM (SELECT *, coalesce(list_position(list_transform(range(1, least(len(pc), len(rc)) + 1), lambda i: pc[i] <> rc[i]), true) - 1, least(len(pc), len(rc))) AS h FROM unlike_ WHERE len(pc) <> len(rc) OR apart <> e))),
 cells_ AS (SELECT doc_id, line_id, e, pc, rc, CAST(0 AS BIGINT) AS d, {_NONE} AS before, {_NONE} AS last FROM bare_ WHERE len(pc) > 0 AND len(rc) > 0 UNION ALL
 SELECT doc_id, line_id, e, pc, rc, d, last, list_transform(range(0, len(pc) + 1), lambda i: {_CELL}) FROM (SELECT doc_id, line_id, e, pc, rc, d + 1 AS d, before, last FROM cells_ WHERE d < len(pc) + len(rc))),
 ways_ AS (SELECT doc_id, line_id, last[-1].s AS s FROM cells_ WHERE d = len(pc) + len(rc) UNION ALL
 SELECT doc_id, line_id, array_to_string(list_transform(list_filter(range(1, len(pc) + 1), lambda i: pc[i] <> rc[i]), lambda i: concat(pc[i], rc[i])), '') FROM unlike_ WHERE len(pc) = len(rc) AND apart = e),
 subs_ AS (SELECT doc_id, line_id, length(s) // 2 - k AS pos, s[2 * k - 1] AS predicted, s[2 * k] AS reference FROM ways_, unnest(range(1, length(s) // 2 + 1)) AS u(k))"""


@query(
    'SELECT predicted, reference, "count" FROM (SELECT predicted, reference, count(*) AS "count", min({\'d\': doc_id, \'l\': line_id, \'p\': pos}) AS first FROM subs_ GROUP BY predicted, reference ORDER BY "count" DESC, first LIMIT 20)',
    "RECURSIVE " + inputs.PAIRS, _DISTANCE, _CONFUSED,
)
def top_confusions(spark, sf):
    return evaluate.top_confusions(inputs.pairs(spark, sf), ["doc_id", "line_id"])


_CODES = lambda x: f"array_to_string(list_transform({x}, lambda w: chr(CAST(33 + list_position(v, w) AS INTEGER))), '')"


@query(
    """SELECT a_cer, a_wer, b_cer, b_wer, round(b_cer - a_cer, 6) AS cer_delta, round(b_wer - a_wer, 6) AS wer_delta FROM (SELECT round(sum(ea) / CAST(sum(n) AS DOUBLE), 6) AS a_cer, round(sum(eb) / CAST(sum(n) AS DOUBLE), 6) AS b_cer, round(sum(wa) / CAST(sum(m) AS DOUBLE), 6) AS a_wer, round(sum(wb) / CAST(sum(m) AS DOUBLE), 6) AS b_wer FROM compared_)""",
    "RECURSIVE " + inputs.LOGITS, _SIMPLE, _SPELLED,
    f"""texts_ AS (SELECT line_id, trim(s.text) AS a, trim(p.text) AS b, trim(lower(s.text)) AS r FROM scored_ s JOIN spelled_ p USING (line_id) WHERE rank = 0),
 words_ AS (SELECT *, list_distinct(list_concat(list_concat(wa, wb), wr)) AS v FROM (SELECT *, {", ".join(f"list_filter(string_split({x}, ' '), lambda x: x <> '') AS w{x}" for x in "abr")} FROM texts_)),
 compared_ AS (SELECT levenshtein(a, r) AS ea, levenshtein(b, r) AS eb, length(r) AS n, levenshtein({_CODES("wa")}, {_CODES("wr")}) AS wa, levenshtein({_CODES("wb")}, {_CODES("wr")}) AS wb, len(wr) AS m FROM words_)""",
)
def decoder_delta(spark, sf):
    logits = inputs.logits(spark, sf)
    greedy = decode.greedy(logits, inputs.VOCAB).select("line_id", "text")
    beam = decode.beam(decode.matrices(logits), inputs.VOCAB, most=1).select("line_id", "text")
    rows = evaluate.decoder_delta(greedy, beam, greedy.select("line_id", F.lower("text").alias("reference")), ["line_id"])
    rates = rows.select(*(F.round(c, 6).alias(c) for c in ("a_cer", "a_wer", "b_cer", "b_wer")))
    return rates.select("*", F.round(F.col("b_cer") - F.col("a_cer"), 6).alias("cer_delta"), F.round(F.col("b_wer") - F.col("a_wer"), 6).alias("wer_delta"))


@query(
    """SELECT CAST(count(*) AS BIGINT) AS num_lines, round(sum(d.e) / CAST(sum(length(d.r)) AS DOUBLE), 6) AS cer, (SELECT round(sum(e) / CAST(sum(n) AS DOUBLE), 6) FROM errors_) AS wer, round(avg(CASE WHEN nfc_normalize(d.p) = nfc_normalize(d.r) THEN 1.0 ELSE 0.0 END), 6) AS exact_match,
 coalesce((SELECT string_agg(concat(ch, ':', tp, ':', fp, ':', fn), ' ' ORDER BY ch) FROM bags_ WHERE in_reference BETWEEN 1 AND 39), '') AS rare FROM distances_ d""",
    inputs.PAIRS, _DISTANCE, _WER, _CHARS,
)
def benchmark_report(spark, sf):
    """Written as JSON and read back: the rates, and the rare characters with what their scores come from."""
    pairs = inputs.pairs(spark, sf)
    path = new_path(spark, "report")
    found = stored(evaluate.counted(pairs, ["doc_id", "line_id"]), "counted")
    files.write_report(evaluate.report_frame(spark, evaluate.report(pairs, ["doc_id", "line_id"], "ckpt", {"decoder": "greedy"}, "test", rare=40, found=found)), path)
    back = spark.read.text(path, wholetext=True)
    field = lambda name, kind: F.get_json_object("value", f"$.{name}").cast(kind)
    listed = F.map_keys(F.from_json(F.get_json_object("value", "$.rare_char_metrics"), "map<string,struct<precision:double,recall:double,f1:double>>"))
    head = back.select(field("num_lines", "long").alias("num_lines"), *(F.round(field(n, "double"), 6).alias(n) for n in ("cer", "wer", "exact_match")), listed.alias("listed"))
    counts = found.where("in_reference between 1 and 39").select("ch", F.concat_ws(":", "ch", "tp", "fp", "fn").alias("c"))
    named = head.select(F.explode("listed").alias("ch")).join(counts, "ch").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ch", "c"))), lambda x: x["c"]), " ").alias("rare"))
    return head.drop("listed").join(named)


# sources and sinks: written to the shared folder, read back


@query("SELECT * FROM pages_", inputs.PAGES)
def manifest_csv(spark, sf):
    path = new_path(spark, "manifest")
    files.write_manifest(inputs.pages(spark, sf), path)
    return files.read_manifest(spark, path)


@query("SELECT p.*, printf('text_%08d.txt', CAST(regexp_extract(image_path, '[0-9]+') AS BIGINT)) AS transcript_path FROM pages_ p", inputs.PAGES)
def manifest_transcripts(spark, sf):
    texts = inputs.images(spark, sf).select("source_id", F.format_string("text_%08d.txt", F.regexp_extract("image_path", "[0-9]+", 0).cast("long")).alias("transcript_path"))
    return manifest.zip_transcripts(inputs.pages(spark, sf), texts)


@query("SELECT word, score FROM lexicon_", inputs.WORDS)
def lexicon_file(spark, sf):
    path = new_path(spark, "lexicon")
    files.write_lexicon(inputs.words(spark, sf), path)
    return files.read_lexicon(spark, path)


@query("SELECT line_id, t, round(log_probs[k + 1], 6) AS best FROM logits_", inputs.LOGITS)
def logits_file(spark, sf):
    path = new_path(spark, "logits")
    files.write_logits(inputs.logits(spark, sf).withColumn("source_id", F.concat(F.lit("s"), F.col("line_id") % 3)), path)
    return spark.read.parquet(path).select("line_id", "t", F.round(F.array_max("log_probs"), 6).alias("best"))


@query("SELECT url, regexp_replace(regexp_extract(url, '[^/]*$'), '^(.+)[.][^.]*$', '\\1') AS stem FROM (SELECT DISTINCT url FROM pages WHERE url IS NOT NULL)")
def file_stem(spark, sf):
    return inputs.table(spark, sf, "pages").where("url is not null").select("url").distinct().select("url", stem(F.col("url")).alias("stem"))


@query("SELECT count(*) AS n FROM lexicon_", inputs.WORDS)
def lexicon_size(spark, sf):
    return lexicon.size(inputs.words(spark, sf))


@query("SELECT DISTINCT word, CAST(1.0 AS DOUBLE) AS score FROM spoken_", inputs.LINES, _SPOKEN)
def lexicon_from_words(spark, sf):
    return lexicon.from_words(_spoken(spark, sf))


@query("SELECT doc_id, line_id, word, count(*) AS n FROM spoken_ SEMI JOIN lexicon_ USING (word) GROUP BY ALL", inputs.LINES, inputs.WORDS, _SPOKEN)
def lexicon_known(spark, sf):
    return lexicon.known(_spoken(spark, sf), inputs.words(spark, sf)).groupBy("doc_id", "line_id", "word").agg(F.count("*").alias("n"))


@query("SELECT doc_id, line_id, md5(concat(prediction, '|', reference)) AS both_md5 FROM pairs_", inputs.PAIRS)
def paired(spark, sf):
    rows = inputs.pairs(spark, sf)
    both = evaluate.paired(rows.select("doc_id", "line_id", "prediction"), rows.select("doc_id", "line_id", "reference"), ["doc_id", "line_id"])
    return both.select("doc_id", "line_id", F.md5(F.concat("prediction", F.lit("|"), "reference")).alias("both_md5"))


# layout


@query("SELECT page, cluster, count(*) AS n, CAST(sum(area) AS BIGINT) AS area FROM clusters_ GROUP BY page, cluster", inputs.COMPONENTS)
def component_clusters(spark, sf):
    return layout.clusters(layout.keep_components(inputs.components(spark, sf))).groupBy("page", "cluster").agg(F.count("*").alias("n"), F.sum("area").cast("long").alias("area"))


@query(
    """SELECT o_orderkey AS page, coalesce(greatest(x0 - 5, 0), 0) AS x, coalesce(greatest(y0 - 5, 0), 0) AS y, coalesce(least(x1 + 5, 600), 600) - coalesce(greatest(x0 - 5, 0), 0) AS w, coalesce(least(y1 + 5, 1000), 1000) - coalesce(greatest(y0 - 5, 0), 0) AS h
 FROM orders LEFT JOIN (SELECT * FROM (SELECT page, cluster, sum(area) AS a, min(lft) AS x0, min(top) AS y0, max(lft + width) AS x1, max(top + height) AS y1 FROM clusters_ GROUP BY page, cluster) QUALIFY row_number() OVER (PARTITION BY page ORDER BY a DESC, cluster) = 1) ON page = o_orderkey""",
    inputs.COMPONENTS,
)
def text_region(spark, sf):
    return layout.text_region(inputs.sheets(spark, sf), inputs.components(spark, sf))


@query("SELECT page, row_ AS \"row\", ink FROM profile_", inputs.INK)
def row_profile(spark, sf):
    return layout.row_profile(inputs.ink(spark, sf))


@query('SELECT page, band, start_ AS "start", end_ AS "end" FROM bands_', inputs.INK)
def projection_bands(spark, sf):
    return layout.bands(layout.row_profile(inputs.ink(spark, sf)))


@query(
    """SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY s) - 1 AS INTEGER) AS line_id, 7 AS x, CAST(11 + s AS INTEGER) AS y, 60 AS w, CAST(e - s AS INTEGER) AS h, CAST(greatest(1, floor(60 * 32 / CAST(e - s AS DOUBLE))) AS INTEGER) AS out_width
 FROM (SELECT b.page, s, e FROM (SELECT page, greatest(start_ - 2, 0) AS s, least(end_ + 2, 1440) AS e FROM bands_) b JOIN ink_ i ON i.page = b.page AND row_ >= s AND row_ < e WHERE e - s >= 10 GROUP BY b.page, s, e HAVING count(DISTINCT col_) >= 3)""",
    inputs.INK,
)
def line_boxes(spark, sf):
    ink = inputs.ink(spark, sf)
    region = ink.select("page").distinct().select("page", F.lit(60).alias("width"), F.lit(1440).alias("height"), F.lit(7).alias("x"), F.lit(11).alias("y"))
    return layout.lines(ink, region, least_width=3, target_height=32)


@query(
    """SELECT page, CAST(level AS INTEGER) AS threshold FROM (SELECT page, level, round(coalesce(w0 * (w - w0) * power(s0 / w0 - (s - s0) / nullif(w - w0, 0), 2) / w / w, 0), 9) AS b FROM
 (SELECT page, level, CAST(sum(n) OVER (PARTITION BY page ORDER BY level) AS DOUBLE) AS w0, CAST(sum(n * level) OVER (PARTITION BY page ORDER BY level) AS DOUBLE) AS s0, CAST(sum(n) OVER (PARTITION BY page) AS DOUBLE) AS w, CAST(sum(n * level) OVER (PARTITION BY page) AS DOUBLE) AS s
 FROM (SELECT page, col_ AS level, count(*) AS n FROM ink_ GROUP BY page, col_))) QUALIFY row_number() OVER (PARTITION BY page ORDER BY b DESC, level) = 1""",
    inputs.INK,
)
def otsu_threshold(spark, sf):
    return layout.otsu(inputs.ink(spark, sf).groupBy("page", F.col("col").alias("level")).agg(F.count("*").alias("n")))


@query(
    """SELECT vec_id, CASE WHEN abs(a) <= 10 AND abs(a) >= 0.1 THEN 'rotate' ELSE 'keep' END AS action, round(CASE WHEN abs(a) > 10 THEN 0.0 ELSE a END, 6) AS angle,
 CAST(trunc(1000 * abs(sin(radians(a))) + 600 * abs(cos(radians(a)))) AS INTEGER) AS new_width, CAST(trunc(1000 * abs(cos(radians(a))) + 600 * abs(sin(radians(a)))) AS INTEGER) AS new_height FROM (SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 60 AS a FROM embeddings)"""
)
def deskew_decision(spark, sf):
    angle = F.get("embedding", 0).cast("double") * 60
    action, kept = layout.skew_action(angle)
    width, height = layout.rotated_size(F.lit(600), F.lit(1000), angle)
    return inputs.table(spark, sf, "embeddings").select("vec_id", action.alias("action"), F.round(kept, 6).alias("angle"), width.alias("new_width"), height.alias("new_height"))


@query("SELECT doc_id, CAST(len(w) AS INTEGER) AS n, CAST(max(len(w)) OVER (PARTITION BY doc_id // 16) AS INTEGER) AS padded FROM words_", inputs.LINES)
def pad_batch(spark, sf):
    rows = inputs.spread(inputs.table(spark, sf, "documents").select("doc_id", "text"))
    sized = rows.select(F.floor(F.col("doc_id") / 16).alias("batch"), "doc_id", F.transform(tokens(F.col("text")), lambda w: F.length(w).cast("double")).alias("v"))
    return decode.pad_batches(sized, "v", "batch").select("doc_id", F.size("v").alias("n"), F.size("padded").alias("padded"))


@query("SELECT line_id // 4 AS page, trim(string_agg(text, ' ' ORDER BY line_id)) AS text, round(avg(sequence_confidence), 6) AS confidence, count(*) AS n_lines FROM scored_ GROUP BY line_id // 4", inputs.LOGITS)
def page_texts(spark, sf):
    rows = confidence.scored(inputs.logits(spark, sf), inputs.VOCAB).withColumn("page", F.floor(F.col("line_id") / 4))
    return service.page_texts(rows).withColumn("confidence", F.round("confidence", 6))
