"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textmill.llm import contamination, packing, quality, simhash, suffixdedup
from textmill.llm.util import documents, stored

#: SQL can't express the stages; tests/llm hold them against brute force.
ORACLE_SQL = None


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts that share four fifths of their five-word shingles or more the smallest doc_id stays."""
    return simhash.one_of_each(docs, words=5, similarity=0.8)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings that start earlier too go."""
    return suffixdedup.trimmed_documents(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of any benchmark item go."""
    return contamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids and places in sequences."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("quality classifier", classify),
    ("SimHash near-dedup", drop_near_copies),
    ("suffix-array dedup", drop_repeats),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{k + 1}")
    return docs
