"""From documents to token ids: quality rules, near duplicates, personal data, mix, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from namewake.llm import chunk_bpe, disclosure, jaccard_join, mixing, quality_rules
from namewake.llm.common import save


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without lines that many documents of a host share."""
    return quality_rules.clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id out of each group of near copies."""
    return jaccard_join.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents, personal data and what discloses it taken out of the text."""
    return disclosure.sanitize(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix of sources takes; a document taken twice is two rows."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, little-endian 16-bit, in place of the text."""
    return chunk_bpe.encode(docs)


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("disclosure", personal_data),
    ("source_mixing", mix),
    ("bpe_chunks", encode),
]

#: Shingle joins, the seeded mix and BPE are beyond SQL; tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
