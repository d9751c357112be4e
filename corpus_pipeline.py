"""A training corpus from raw documents: quality, line dedup, near-dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet in the shared folder and reads it again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palimpsest.llm import queries
from palimpsest.llm.storage import materialize
from palimpsest.plans.inputs import spread, table

STAGES = [
    ("quality_rules", queries.quality_stage),
    ("line_dedup", queries.line_dedup_stage),
    ("simhash_near_dedup", queries.simhash_stage),
    ("benchmark_decontamination", queries.decontamination_stage),
    ("byte_bpe", queries.bpe_stage),
]

#: Expectation-maximisation, components over fingerprints and BPE are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
