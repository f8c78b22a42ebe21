"""Connected components of an edge list by alternating stars, in DataFrame joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.util import forget, stored


def components(edges: DataFrame, name: str = "links") -> DataFrame:
    """edges(a long, b long) -> node, root: the smallest node reachable, for each node with an edge to another.

    Large star: every node points its larger neighbours to its smallest one; small star: to the smallest of the
    smaller ones. Each round is written to the shared folder in place of the last; rounds grow with the logarithm of the diameter.
    Nulls and loops are ignored; an empty input gives an empty result.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.where("m < u").select("u", "m")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m")).where("u <> v").distinct()
        old, e = e, stored(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
        forget(old)
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
        if now == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
