"""From raw documents to packed training sequences, one operator per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tunehouse.llm import mixing, packing, pii, quality_crf, simhash
from tunehouse.llm.common import landed, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier predicts to be bad go."""
    return quality_crf.keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of the smallest doc_id."""
    return simhash.keep_one(docs, words=3, max_bits=2)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by surrogates."""
    return pii.replace_personal_data(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights; a document has a row for each time it is taken."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_dedup),
    ("pii_surrogates", private),
    ("mixing", mix),
    ("packing", pack),
]

#: The classifier and the packing cannot be said in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again before the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name)[0]
    return STAGES[-1][1](spark, docs, sf_dir)
