"""First-occurrence deduplication: exact by normalised hash, near by MinHash bands.

"First" is the order of a key column `seq`, which must be unique. The near rule keeps a document unless an
earlier *kept* one shares a band bucket with it: the lexicographically first maximal independent set.
"""

from __future__ import annotations

import random

try:  # without the library of ciphers, which costs more than the digest of a short text
    from _md5 import md5
except ImportError:
    from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.quality import normalized_hash
from textmill.functions.text import NO_WORD, text_of
from textmill.session import materialized

# Fixed value: the modulus of the hash family.
PRIME = 4294967311


def mark_exact(df: DataFrame, text: str, seq: str = "seq", into: str = "is_duplicate") -> DataFrame:
    """Adds norm_hash and whether an earlier row has the same one. The first row of a hash comes from an aggregate
    with map-side combination, so that a hash with very many rows isn't gathered in one task."""
    df = df.withColumn("norm_hash", normalized_hash(F.col(text)))
    first = df.groupBy("norm_hash").agg(F.min(seq).alias("_first"))
    return df.join(first, "norm_hash").withColumn(into, F.col(seq) > F.col("_first")).drop("_first")


def firsts(df: DataFrame, seq: str = "seq") -> DataFrame:
    """The seq of the first row of each norm_hash: keys alone meet, texts stay where they are."""
    return df.groupBy(F.unhex("norm_hash").alias("h")).agg(F.min(seq).alias(seq)).select(seq)


def against_history(df: DataFrame, history: DataFrame) -> DataFrame:
    """Rows whose norm_hash isn't in history(norm_hash)."""
    return df.join(history.select("norm_hash"), "norm_hash", "left_anti")


def grams(w: Column, n: int = 2) -> Column:
    """Word n-grams of a column of words; fewer words than n give one gram of them all, none give none. Words should
    be a plain column, since they are used more than once. Shifted arrays are zipped: a slice for each gram would copy
    all words each time."""
    slide = F.slice(w, F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(0)))
    for k in range(1, n):
        slide = F.zip_with(slide, F.slice(w, F.lit(k + 1), F.greatest(F.size(w) - n + 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(w) >= n, slide).when(F.size(w) > 0, F.array(F.concat_ws(" ", w))).otherwise(F.array().cast("array<string>"))


def signatures(df: DataFrame, text: str, seq: str = "seq", num_perm: int = 128, seed: int = 42) -> DataFrame:
    """seq, sig of each row's text, written once: else a filter on sig would take the words apart again."""
    return materialized(df.select(seq, signature(joined_words(F.col(text)), num_perm, seed).alias("sig")), "signatures")


def joined_words(c: Column) -> Column:
    """words(c) with a space between them."""
    return F.trim(F.regexp_replace(F.lower(text_of(c)), NO_WORD, " "))


def hashed(words: str) -> np.ndarray:
    """The first four bytes of the MD5 of each distinct pair of neighbouring words, or of the only word."""
    w = words.split(" ") if words else []
    pairs = set(map(" ".join, zip(w, w[1:], strict=False))) if len(w) > 1 else w
    return np.frombuffer(b"".join([md5(x.encode()).digest()[:4] for x in pairs]), ">u4").astype(np.uint64)


def family(num_perm: int = 128, seed: int = 42) -> tuple[list[int], list[int]]:
    """Multipliers and offsets, all multipliers drawn first."""
    r = random.Random(seed)
    return [r.randint(1, PRIME - 1) for _ in range(num_perm)], [r.randint(0, PRIME - 1) for _ in range(num_perm)]


def least(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each hash function over h; zeros without any. Blocks stay within a core's cache, and division
    by a constant with a product taken off is several times as fast as a remainder."""
    p, best = np.uint64(PRIME), np.full(len(a), PRIME, np.uint64)
    if not len(h):
        return np.zeros(len(a), np.int64)
    whole = int(a.max()) < 2**32  # then a * x + b stays below 2**64
    for at in range(0, len(h), 128):
        x = h[at : at + 128]
        y = a * x if whole else a * (x >> np.uint64(16)) % p * np.uint64(65536) + a * (x & np.uint64(0xFFFF))
        y += b
        q = y // p
        q *= p
        y -= q
        np.minimum(best, y.min(1), out=best)
    return best.astype(np.int64)


def signature(joined: Column, num_perm: int = 128, seed: int = 42) -> Column:
    """The least value of each hash function over the pairs of joined_words(); zeros without words."""
    a, b = (np.array(x, np.uint64)[:, None] for x in family(num_perm, seed))

    @F.pandas_udf("array<long>")
    def run(col: pd.Series) -> pd.Series:
        return pd.Series([least(hashed(x), a, b) for x in col])

    return run(joined)


def bucket_keys(text: Column, num_perm: int = 128, n_bands: int = 32, seed: int = 42) -> Column:
    """16 bytes of a hash for each band of the text's signature, one after the other; null without words or for null.
    They stand for band_id and bucket_hash of bands(), which take five times the room."""
    a, b = (np.array(x, np.uint64)[:, None] for x in family(num_perm, seed))
    r = num_perm // n_bands

    def keys(x: str | None) -> bytes | None:
        s = least(hashed(x), a, b) if x else None
        if s is None or not s.any():
            return None
        s = s.astype("<i8")
        return b"".join([md5(k.to_bytes(4, "little") + s[k * r : k * r + r].tobytes()).digest() for k in range(n_bands)])

    @F.pandas_udf("binary")
    def run(col: pd.Series) -> pd.Series:
        return pd.Series([keys(x) for x in col], dtype=object)

    return run(F.when(text.isNotNull(), joined_words(text)))


def key_rows(df: DataFrame, keys: str, seq: str = "seq") -> DataFrame:
    """seq, key: a row for each of bucket_keys()."""
    n = F.octet_length(keys) / 16
    each = F.transform(F.sequence(F.lit(0), n.cast("int") - 1), lambda i: F.substring(F.col(keys), i * 16 + 1, F.lit(16)))
    return df.where(F.col(keys).isNotNull()).select(seq, F.explode(each).alias("key"))


def shared_rows(rows: DataFrame) -> DataFrame:
    """The rows (seq, key) whose key has others, and few more: keys are counted by eight bytes of a hash, since most
    have one row only and all of them are counted."""
    rows = rows.withColumn("h", F.xxhash64("key"))
    more = rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    return rows.join(more, "h", "left_semi").drop("h")


def bands(df: DataFrame, sig: str, seq: str = "seq", n_bands: int = 32, num_perm: int = 128) -> DataFrame:
    """seq, band_id, bucket_hash; rows with an all-zero signature have none."""
    r = num_perm // n_bands
    keys = F.transform(F.sequence(F.lit(0), F.lit(n_bands - 1)), lambda i: F.sha2(F.concat(F.lit("("), F.array_join(F.slice(F.col(sig), i * r + 1, r), ", "), F.lit(")")).cast("binary"), 256))
    return df.where(F.exists(sig, lambda x: x != 0)).select(seq, F.posexplode(keys).alias("band_id", "bucket_hash"))


def near_losers(buckets: DataFrame, seq: str = "seq") -> DataFrame:
    """The seq of rows that share a bucket with an earlier kept one, from seq and key or band_id and bucket_hash.

    In each round the open rows that come first in all their buckets are kept, and whoever shares a bucket with
    them is dropped: linear in the buckets' rows, no pairs. A round writes one table, of what became of its open rows,
    and the next one reads those that are still open. Rounds grow with the longest chain in which each row shares a
    bucket with the next only; rows around one text need two.
    """
    spark = buckets.sparkSession
    key = F.col("key") if "key" in buckets.columns else F.unhex(F.md5(F.concat_ws(":", "band_id", "bucket_hash").cast("binary")))
    state = materialized(shared_rows(buckets.select(F.col(seq).alias("seq"), key.alias("key"))).withColumn("fate", F.lit("open")), "rounds")
    rounds = [state]
    while (open_ := state.where("fate = 'open'").drop("fate")).limit(1).count():
        first = open_.groupBy("key").agg(F.min("seq").alias("first"))
        kept = open_.join(first, "key").groupBy("seq").agg(F.min(F.col("seq") == F.col("first")).alias("kept"))
        marked = open_.join(kept, "seq")
        taken = marked.where("kept").select("key").distinct()
        lost = marked.where("not kept").join(taken, "key", "left_semi").select("seq").distinct().withColumn("lost", F.lit(True))
        fate = F.when(F.col("kept"), "kept").when(F.col("lost"), "lost").otherwise("open")
        state = materialized(marked.join(lost, "seq", "left").select("seq", "key", fate.alias("fate")), "rounds")
        rounds.append(state)
    return spark.read.schema(state.schema).parquet(*[x.written_to for x in rounds]).where("fate = 'lost'").select("seq").distinct()


def mark_near(df: DataFrame, text: str, seq: str = "seq", num_perm: int = 128, n_bands: int = 32, seed: int = 42, into: str = "is_near_duplicate") -> DataFrame:
    keys = materialized(df.select(seq, bucket_keys(F.col(text), num_perm, n_bands, seed).alias("keys")), "keys")
    return with_near(df, keys, seq, into)


def with_near(df: DataFrame, keys: DataFrame, seq: str = "seq", into: str = "is_near_duplicate") -> DataFrame:
    lost = near_losers(key_rows(keys, "keys", seq), seq).withColumnRenamed("seq", "_lost")
    return df.join(lost, F.col(seq) == F.col("_lost"), "left").withColumn(into, F.col("_lost").isNotNull()).drop("_lost")


def near_pairs(keys: DataFrame, seq: str = "seq") -> DataFrame:
    """Diagnostic: each row's earliest partner in each bucket (seq_a < seq_b), not all pairs; from stored bucket_keys()."""
    rows = shared_rows(key_rows(keys, "keys", seq))
    first = rows.groupBy("key").agg(F.min(seq).alias("seq_a"))
    return rows.join(first, "key").where(F.col("seq_a") < F.col(seq)).select("seq_a", F.col(seq).alias("seq_b")).distinct()
