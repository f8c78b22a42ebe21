"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

An item is a set of windows of `width` consecutive words. Containment of a window is asked for in full, so one
token is a sufficient prefix: the window's rarest word over the whole corpus. Every document word is looked up
among these prefix words; a match fixes where the window would have to lie (positional bound), it must lie
inside the document (length bound), and its words are compared one by one (exact check).

The lookup is broadcast in blocks of at most `block` windows, so its size is bounded whatever the benchmark's
size; nothing is shuffled but one row per document and the verified hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What separates words, and the letters that are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null and empty texts have none."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(low, SEPARATORS), "")


def windows_of(items: DataFrame, width: int) -> DataFrame:
    """(win, items): each distinct window with the sorted ids of its items. Shorter items are one window."""
    w = items.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w")).where("item is not null and size(w) > 0")
    w = w.withColumn("n", F.least(F.lit(width), F.size("w")))
    w = w.select("item", F.explode(F.expr("transform(sequence(0, size(w) - n), s -> slice(w, s + 1, n))")).alias("win"))
    return w.groupBy("win").agg(F.array_sort(F.collect_set("item")).alias("items"))


def prefixed(docs: DataFrame, wins: DataFrame, few: bool) -> DataFrame:
    """Adds to each window its rarest word over all documents (ties: the smaller word) and that word's place."""
    vocab = wins.select(F.explode("win").alias("word")).distinct()
    seen = docs.select(F.explode(words_of(F.col("text"))).alias("word"))
    if few:
        seen = seen.join(F.broadcast(vocab), "word", "left_semi")
    counts = seen.groupBy("word").agg(F.count("*").alias("n"))
    if not few:
        counts = counts.join(vocab, "word", "left_semi")
    each = wins.select("win", "items", F.posexplode("win").alias("off", "word")).join(counts, "word", "left")
    rare = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "off")).alias("rare")
    return each.groupBy("win").agg(rare, F.first("items").alias("items")).select(F.col("rare.word").alias("key"), F.col("rare.off").alias("off"), F.size("win").alias("len"), "win", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 8, min_items: int = 2, block: int = 200_000) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_words, n_hit (words inside an occurrence of any window),
    n_items (items with an occurring window), items_sha256, contaminated (n_items >= min_items), text_hash.

    Null and empty texts have no words and no hits; a null doc_id is kept; repeated rows each get a row; items
    with null id or text, or without words, match nothing; an empty benchmark gives zeros. Other columns are ignored.
    """
    from textmill.llm.util import stored

    wins = windows_of(benchmark.select("item_id", "text"), width)
    n = wins.count()
    keyed = stored(prefixed(docs, wins, n <= block), "windows")
    # The row's number keeps repeated ids apart; '' stands once at the end of each document, so that documents without hits have a row too.
    base = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash"), words_of(F.col("text")).alias("w"))
    end = docs.sparkSession.sql("select '' key, 0 off, 0 len, cast(array() as array<string>) win, cast(array() as array<string>) items")
    blocks = max(1, -(-n // block))
    parts = []
    for b in range(blocks):
        some = keyed.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b) if blocks > 1 else keyed
        each = base.select("rid", "doc_id", "text_hash", "w", F.posexplode(F.concat("w", F.array(F.lit("")))).alias("pos", "key"))
        hits = each.join(F.broadcast(some.unionByName(end) if b == 0 else some), "key")
        hits = hits.where("pos >= off and pos - off + len <= size(w) and slice(w, pos - off + 1, len) = win")
        parts.append(hits.select("rid", "doc_id", "text_hash", F.size("w").alias("n"), (F.col("pos") - F.col("off")).alias("start"), "len", "items"))
    hits = reduce(DataFrame.unionByName, parts)
    span = F.when(F.col("len") > 0, F.struct("start", "len"))
    per = hits.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"), F.max("n").alias("n"), F.array_sort(F.collect_list(span)).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    covered = "aggregate(spans, struct(0L as n, 0L as till), (a, x) -> struct(a.n + greatest(0L, x.start + x.len - greatest(a.till, x.start)), greatest(a.till, cast(x.start + x.len as long))), a -> a.n)"
    return per.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        F.expr(covered).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("items") >= min_items).alias("contaminated"),
        "text_hash",
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, width: int = 8, min_items: int = 1) -> DataFrame:
    """The rows of docs, with all their columns, that hold windows of fewer than min_items items."""
    found = contamination(docs, benchmark, width, min_items).where("contaminated").select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).distinct()
    own = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found["hit_id"]) & (own == found["hit_hash"]), "left_anti")
