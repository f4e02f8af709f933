"""The training-data pipeline: quality, exact copies, near copies, mixture, tokens. Each stage reads what its predecessor
wrote; all but the last return documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfspark.llm import byte_bpe, exact_dedup, mixing, near_dedup, quality_model, registry, ship
from shelfspark.session import settle


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the ratings of ``labels``, accepts."""
    ship(spark)
    return quality_model.accepted(docs, registry.quality(spark, docs, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-copies."""
    ship(spark)
    return near_dedup.without_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture."""
    return mixing.mixture(docs, registry.TARGETS, registry.OTHER_SOURCES)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number and digest of its ids and the digest of what they decode to."""
    ship(spark)
    return byte_bpe.round_trip(docs, registry.RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode_texts),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    found = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        found = stage(spark, found, sf_dir)
        if i < len(STAGES) - 1:
            found = settle(found, "stage")
    return found
