"""Session settings and the shared folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Rows in an Arrow batch to a Python worker while a table is written, so that long texts stay within its memory.
BATCH_ROWS = 1000


def session(name: str = "textmill", **conf: str) -> SparkSession:
    """A session in UTC with ANSI arithmetic; conf adds or overrides settings."""
    b = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.ansi.enabled", "true")
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


@functools.cache
def own_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix="textmill-")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where that is unset, a local run has a temporary folder of its own,
    and a cluster gets an error, since its machines share no temporary folder."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return at or own_dir(spark.sparkContext.applicationId)


def materialized(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: cuts lineage, and outlives executors. Tables of an application
    stand in one folder, which clean_up() removes. The files of the exchanges that the table came through go as soon as
    it is written, not when the driver happens to collect garbage."""
    path = f"{own_tables(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    conf, batch = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    held = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", batch: str(min(BATCH_ROWS, int(conf.get(batch))) if int(conf.get(batch)) > 0 else BATCH_ROWS)}
    before = {k: conf.get(k) if k == batch else conf.get(k, "false") for k in held}
    for k, v in held.items():
        conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            conf.set(k, v)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def own_tables(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/textmill/{spark.sparkContext.applicationId}"


def removed(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def forget(df: DataFrame) -> None:
    """Removes the table of materialized(), when nothing reads it any more."""
    removed(df.sparkSession, df.written_to)


def clean_up(spark: SparkSession) -> None:
    """Removes all tables that this application has materialized; results that aren't written yet are lost."""
    removed(spark, own_tables(spark))


def spread(df: DataFrame) -> DataFrame:
    """df dealt over all cores where its files split into fewer parts than there are cores, as small tables of one
    row group do; larger tables stay as they are, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
