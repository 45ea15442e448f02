"""A training corpus in five stages: toxic documents go, near-duplicates go, personal data is masked, sources are mixed, texts are encoded.

Every stage takes the documents that its predecessor kept and, but for the
last, returns the columns of ``documents``.

Defined results: null and empty texts are judged by each stage like any
other (see the operators): they aren't toxic, all of them are near-duplicates
of each other, hold no personal data, take no words of the mix and have no
tokens.  Rows that repeat id and text are one document from the second stage
on; rows that repeat an id, or have none, are judged by their texts.  Columns
beside those of ``documents`` are carried up to the last stage, whatever their
names.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievework.llm import bpe, mixing, pii, simhash, toxicity
from sievework.plans.shared import materialize


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below their language's threshold."""
    return toxicity.keep_clean(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash near-duplicates."""
    return simhash.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact(docs, pii.train())


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    return mixing.mix(docs)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    return bpe.encode(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("simhash_dedup", near_dedup),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode_bpe),
]

#: The stages hold trained models and seeded samples that SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
