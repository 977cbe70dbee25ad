"""A training corpus from raw documents: rules, exact and near duplicates, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet in the shared folder and
read back as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from mercata.llm import exact_dedup, mixing, near_dedup, packing, quality
from mercata.llm.common import ship, table
from mercata.session import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or look unlike trusted ones go."""
    ship(spark)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    ship(spark)
    return exact_dedup.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts with similar five-word shingles the document of smallest doc_id stays."""
    ship(spark)
    return near_dedup.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the proportion 1, 2, 3, repeating; a document comes as often as it is taken (0 to 3 times)."""
    ship(spark)
    return mixing.mix(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 tokens."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0).drop("ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("minhash_near_dedup", near_copies),
    ("mixing_weights", source_mix),
    ("best_fit_packing", packed_sequences),
]

#: Token ids, minhash tables and the packing's order are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
