"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.common import settled


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that can be reached, for every node of an edge.

    Each round hangs every node's larger neighbours, then its smaller ones, on
    the smallest of them; the number of rounds grows with the logarithm of the
    longest path.  Minima are combined before the shuffle; every round is
    written to the shared folder.  Null ends are ignored."""
    u, v = F.col("u"), F.col("v")
    pairs = settled(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                    .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "cc-0")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        hung = both.where(v > u).join(least, "u").select(v.alias("u"), F.col("m").alias("v")).distinct()
        root = hung.groupBy("u").agg(F.min("v").alias("m"))
        pairs = settled(hung.join(root, "u").where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
                        .unionByName(root.select("u", F.col("m").alias("v"))).distinct(), "cc-round")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return pairs.select(u.alias("node"), v.alias("component")).unionByName(
        pairs.select(v.alias("node"), v.alias("component")).distinct())
