"""Chunks, splits, shards, leakage and manifests."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.config import Dataset, Filtering
from textmill.functions.quality import token_estimate, word_count
from textmill.functions.text import strip, text_of
from textmill.session import materialized

SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


def packed(parts: list[str], joint: str, most: int) -> Iterator[str]:
    """Joins parts in order while they fit; a part costs its length and the joint, the first one after a full
    chunk its length alone."""
    held, used = [], 0
    for part in parts:
        if used + len(part) + len(joint) <= most:
            held.append(part)
            used += len(part) + len(joint)
            continue
        if held:
            yield joint.join(held)
        held, used = [part], len(part)
    if held:
        yield joint.join(held)


def chunked(text: str, most: int = 4000) -> list[str]:
    """Pieces of at most `most` characters at paragraph ends, or sentence ends within a longer paragraph; a longer
    sentence stays whole. A text that fits is one piece, an empty one none."""
    if len(text) <= most:
        return [text] if text else []
    runs: list[list[str]] = [[]]
    for para in text.split("\n\n"):  # a longer paragraph stands between runs of others
        if len(para) > most:
            runs += [[para], []]
        else:
            runs[-1].append(para)
    out: list[str] = []
    for run in runs:
        if len(run) == 1 and len(run[0]) > most:
            out += packed(SENTENCE_END.split(run[0]), " ", most)
        else:
            out += packed(run, "\n\n", most)
    return out


def chunks(c: Column, cfg: Filtering = Filtering()) -> Column:
    """Array of chunks: of texts over max_character_length, if asked for; others are one chunk, also empty ones."""
    most = cfg.chunk_max_characters

    @F.pandas_udf("array<string>")
    def cut(t: pd.Series) -> pd.Series:
        return t.map(lambda x: chunked(x, most))

    t = text_of(c)
    if not cfg.chunk_long_documents:
        return F.array(t)
    return F.when(F.length(t) > cfg.max_character_length, cut(F.when(F.length(t) > cfg.max_character_length, t).otherwise(""))).otherwise(F.array(t))


def chunk_column(c: Column, most: int = 4000) -> Column:
    @F.pandas_udf("array<string>")
    def cut(t: pd.Series) -> pd.Series:
        return t.map(lambda x: chunked(x, most))

    return cut(text_of(c))


def uniform(norm_hash: Column, seed: int = 42) -> Column:
    """0 to 1 from the seed and the text's hash: the same in any order and partitioning."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), norm_hash).cast("binary"), 256), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def split_of(u: Column, cfg: Dataset = Dataset()) -> Column:
    return F.when(u < cfg.train_ratio, "train").when(u < cfg.train_ratio + cfg.validation_ratio, "validation").otherwise("test")


def sequence_split(df: DataFrame, seq: str = "seq", cfg: Dataset = Dataset()) -> DataFrame:
    """Adds split by one seeded draw per row in seq order. The draws run in order, so the order is total: for
    datasets whose accepted rows one task can number."""
    def draw(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = random.Random(cfg.seed)
        for pdf in it:
            yield pdf.assign(_u=[r.random() for _ in range(len(pdf))])

    rows = df.select(F.col(seq).alias("_s")).orderBy("_s").coalesce(1)
    drawn = rows.mapInPandas(draw, f"_s {df.schema[seq].dataType.simpleString()}, _u double")
    return df.join(drawn, F.col(seq) == F.col("_s")).withColumn("split", split_of(F.col("_u"), cfg)).drop("_s", "_u")


def shards(df: DataFrame, seq: str = "seq", cfg: Dataset = Dataset()) -> DataFrame:
    """Adds place (from 0, of a row in its split, in seq order) and shard by the document limit. Rows are numbered per
    range first, so that no task holds a whole split. The ranges are stored: their bounds come from a sample, which
    differs from one evaluation to the next. Other columns of df are stored too, so that it should have few."""
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(parts, "split", seq).sortWithinPartitions("split", seq).withColumn("_id", F.monotonically_increasing_id())
    ranged = materialized(ranged, "ranges").withColumn("_p", F.shiftright("_id", 33))
    sizes = ranged.groupBy("split", "_p").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = sizes.withColumn("_b", F.sum("_n").over(Window.partitionBy("split").orderBy("_p")) - F.col("_n")).drop("_n")
    out = ranged.join(F.broadcast(before), ["split", "_p"]).withColumn("place", F.col("_b") + F.col("_id") - F.col("_first"))
    limit = cfg.shard_max_documents
    return out.withColumn("shard", F.floor(F.col("place") / limit) if limit > 0 else F.lit(0).cast("long")).drop("_p", "_id", "_b", "_first")


def leaks(df: DataFrame, text: str = "text", split: str = "split") -> DataFrame:
    """split_a, split_b, n_shared: stripped texts that two splits share."""
    h = df.select(F.col(split).alias("split"), F.sha2(strip(text_of(F.col(text))).cast("binary"), 256).alias("h")).distinct()
    each = h.groupBy("h").agg(F.sort_array(F.collect_set("split")).alias("s")).where(F.size("s") > 1)
    pairs = F.flatten(F.transform("s", lambda a: F.transform(F.filter("s", lambda b: b > a), lambda b: F.struct(a.alias("split_a"), b.alias("split_b")))))
    return each.select(F.explode(pairs).alias("p")).groupBy("p.split_a", "p.split_b").agg(F.count("*").alias("n_shared"))


def counts(df: DataFrame, *by: str, text: str = "text", tokens=token_estimate) -> DataFrame:
    """Documents, characters, words and estimated tokens per group; `tokens` is any Column function."""
    t = F.col(text)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return df.groupBy(*by).agg(F.count("*").alias("document_count"), total(F.length(text_of(t))).alias("character_count"), total(word_count(t)).alias("word_count"), total(tokens(t)).alias("estimated_token_count"))
