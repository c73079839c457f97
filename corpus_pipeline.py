"""A training corpus from raw documents, in five stages.

``STAGES`` lists (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame.  Every stage's result is written as Parquet and
read back as the next one's documents, so a stage works on all rows that its
predecessor kept and a lost executor never recomputes an earlier stage.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from routekpi.llm import exact_dedup, mixing, near_dedup, packing, quality
from routekpi.llm.scratch import save

TOKENIZER = "byte_bpe_50k.json"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones, doesn't reject."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality.select(docs, labels)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each normalised text."""
    return exact_dedup.drop_exact(docs)


def unlike_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8 or more)."""
    return near_dedup.drop_near(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the sources' target weights take them, in training order."""
    return mixing.take(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_classifier", good_documents),
    ("exact_dedup", distinct_documents),
    ("near_dedup", unlike_documents),
    ("mixing", mixed_documents),
    ("packing", packed_sequences),
]

#: The classifier, the hashes of shingles and the tokenizer can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name)
    return docs
