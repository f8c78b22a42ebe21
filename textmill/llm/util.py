"""What the operators share: input columns, folds, the shared folder, bounded Arrow batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.session import forget, materialized, shared_dir, spread

__all__ = ["bounded_batches", "buckets", "documents", "fold", "forget", "id_text", "partitions", "shared_dir", "stored"]

#: What several steps read is written once: later ones don't recompute it, and a lost executor costs only its own tasks.
stored = materialized

#: Rows in one Arrow batch to a Python worker, so that long texts stay within its memory.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Lower Arrow batches to BATCH_ROWS unless the session already asks for smaller ones."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def id_text(docs: DataFrame) -> DataFrame:
    """doc_id as long and text (null: empty) as UTF-8 bytes; other columns, whatever their names, stay behind."""
    bounded_batches(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("body"),
    )


def fold(doc_id: Column, mod: int) -> Column:
    """crc32(doc_id as text) mod `mod`; a null id counts as empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod).cast("int")


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def buckets(df: DataFrame, each: int = 64 << 20) -> int:
    """Partitions for an exchange that gathers a bucket in a worker's memory: of about `each` bytes of input, as Spark
    estimates it, and the session's number at least. Where there is no estimate it is the session's number."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(partitions(df.sparkSession), size // each if size < 1 << 60 else 1)
