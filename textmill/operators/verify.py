"""Manifest of written files and the checks of a finished dataset."""

from __future__ import annotations

import json
import os
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from textmill.functions.text import strip
from textmill.operators.dataset import counts, leaks
from textmill.sources.files import file_sha256

PARTS = ("train", "validation", "test", "rejected", "quarantine")


@F.pandas_udf(StringType())
def digest(path: pd.Series) -> pd.Series:
    """SHA-256 of files, block by block, so that none has to fit into a value."""
    return path.map(lambda p: file_sha256(re.sub(r"^file:/+", "/", p)))


def relative(path, out: str):
    return F.regexp_replace(path, r"^file:/*", "/").substr(F.lit(len(os.path.abspath(out)) + 2), F.lit(10_000))


def manifest(spark: SparkSession, out: str) -> DataFrame:
    """filepath, size_bytes, sha256 and the counts of JSON lines of each file."""
    paths = [p for s in PARTS if os.path.isdir(p := os.path.join(os.path.abspath(out), s))]
    kind = "filepath string, size_bytes long, sha256 string, document_count long, character_count long, word_count long, estimated_token_count long"
    if not paths:
        return spark.createDataFrame([], kind)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).where(~F.col("path").rlike(r"/(_SUCCESS|\.[^/]*\.crc)$"))
    files = files.select(relative(F.col("path"), out).alias("filepath"), F.col("length").alias("size_bytes"), digest("path").alias("sha256"))
    lines = spark.read.option("recursiveFileLookup", True).text(paths).select(relative(F.col("_metadata.file_path"), out).alias("filepath"), "value")
    v = F.try_parse_json("value")
    lines = lines.where(F.schema_of_variant(v).startswith("OBJECT") & F.col("filepath").rlike(r"\.jsonl?$")).select("filepath", F.coalesce(F.try_variant_get(v, "$.text", "string"), F.lit("")).alias("text"))
    per = counts(lines, "filepath")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("document_count", "character_count", "word_count", "estimated_token_count")]
    return files.join(per, "filepath", "left").select("filepath", "size_bytes", "sha256", *zero).orderBy("filepath")


def write_manifest(spark: SparkSession, out: str) -> DataFrame:
    """manifest/manifest.json and manifest/SHA256SUMS; returns the manifest's rows (one per file)."""
    rows = [r.asDict() for r in manifest(spark, out).collect()]
    at = os.path.join(out, "manifest")
    os.makedirs(at, exist_ok=True)
    with open(os.path.join(at, "manifest.json"), "w", encoding="utf-8") as f:
        json.dump({"dataset_version": "1.0", "files": rows}, f, indent=2, ensure_ascii=False)
    with open(os.path.join(at, "SHA256SUMS"), "w", encoding="utf-8") as f:
        f.writelines(f"{r['sha256']}  {r['filepath']}\n" for r in rows)
    kind = "filepath string, size_bytes long, sha256 string, document_count long, character_count long, word_count long, estimated_token_count long"
    return spark.createDataFrame([tuple(r.values()) for r in rows], kind)


def violations(spark: SparkSession, out: str, listed: DataFrame) -> DataFrame:
    """check, file, detail: digests that differ, lines that aren't JSON, texts that are empty or not UTF-8, and texts
    that two splits share. Files that the manifest doesn't list aren't compared."""
    paths = [p for s in PARTS[:3] if os.path.isdir(p := os.path.join(os.path.abspath(out), s))]
    kind = "check string, file string, detail string"
    if not paths:
        return spark.createDataFrame([], kind)
    now = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").load(paths).select(relative(F.col("path"), out).alias("file"), digest("path").alias("sha"))
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").text(paths).select(relative(F.col("_metadata.file_path"), out).alias("file"), "value").where(strip(F.col("value")) != "")
    v = F.try_parse_json("value")
    bad = lines.where(~F.is_valid_utf8("value")).select("file").distinct()
    lines = lines.select("file", "value", v.isNotNull().alias("json"), F.coalesce(F.try_variant_get(v, "$.text", "string"), F.lit("")).alias("text"))
    row = lambda df, name, detail: df.select(F.lit(name).alias("check"), "file", detail.alias("detail"))
    found = row(now.join(listed.select(F.col("filepath").alias("file"), "sha256"), "file").where("sha <> sha256"), "sha256", F.col("sha"))
    found = found.union(row(bad, "utf8", F.lit("")))
    found = found.union(row(lines.where("not json"), "json", F.substring("value", 1, 200)))
    found = found.union(row(lines.where("json").where(strip(F.col("text")) == ""), "empty", F.lit("")))
    shared = leaks(lines.where("json").withColumn("split", F.split("file", "/")[0]))
    return found.union(shared.select(F.lit("leak"), F.concat_ws("/", "split_a", "split_b"), F.col("n_shared").cast("string")))
