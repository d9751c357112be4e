"""The registered queries: each applies an operator with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.inputs import spread, table
from . import bpe, decontam, licenses, linededup, neardup, prefixtrie, quality, secrets, sharding, simhash, suffixdedup, urlfilter, warc, whitening
from .storage import fresh, new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(table(spark, sf_dir, name))


def tokenizer(spark: SparkSession, name: str = "byte_bpe_multi_50k.tiktoken") -> bpe.Tokenizer:
    import public_tokenizers

    return bpe.Tokenizer(spark, public_tokenizers.path(name), public_tokenizers.PATTERN)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda x: x["number"] < len(secrets.BASE))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(r.kind) for r in secrets.BASE), F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("found")).alias("spans"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = sharding.lookup_table(spark, [f"shard{i:03d}" for i in range(sharding.SHARDS)])
    return sharding.place(_table(spark, sf_dir, "documents").select("doc_id"), "doc_id", table)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents")).withColumn("dice", F.round("dice", 6))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write(warc.records(_table(spark, sf_dir, "pages")), path)
    back = warc.read(spark, path, payload="digest")
    digest = F.coalesce("computed_digest", "payload_digest")
    return back.select(warc.page_of("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", warc.page_of("refers_to").alias("refers_to"))


def _tokens(ids: str) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = tokenizer(spark).round_trip(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return both.select("doc_id", _tokens("ids").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out, taken = linededup.remove_repeats(docs)
    return out.select("doc_id", F.col(taken).alias("removed_lines"), F.length("text").cast("long").alias("kept_chars"), F.md5("text").alias("kept_md5"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.assess(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *(F.col(f"features.{n}") for n in quality.FEATURES[:5]), "base_failed", "kept", "quality")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.trie(_table(spark, sf_dir, "conversations"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, kept, size, spans = suffixdedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col(size).alias("n_bytes"), (F.col(size) - F.octet_length(kept)).alias("n_removed"), F.size(spans).cast("long").alias("n_spans"), F.sha2(kept, 256).alias("kept_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


# the pipeline's stages: (spark, docs, sf_dir) -> documents


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents less repeated lines; one that has lost lines and has no word left is all repeats and goes."""
    out, taken = linededup.remove_repeats(docs)
    left = out.where((F.col(taken) == 0) | F.regexp_like("text", F.lit("\\S")))
    return _counted(left.drop(taken))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, _table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their columns, and the ids (packed as unsigned 32-bit integers), their number, their digest and that of the text decoded from them."""
    ids, decoded, tokens, digest, back = fresh(docs.columns, "ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256")
    both = tokenizer(spark).round_trip(docs, ids_col=ids, decoded_col=decoded)
    return both.select(*docs.columns, ids, _tokens(ids).alias(tokens), F.sha2(ids, 256).alias(digest), F.sha2(decoded, 256).alias(back))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_secrets, op2_sharding, op3_licenses, op4_simhash, op5_warc, op6_bpe, op7_decontamination, op8_line_dedup, op9_url_filter, op10_quality, op11_prefix_trie, op12_suffix_dedup, op13_whitening)
}
