"""Connected components of a large graph by alternating large-star and small-star
steps: each step is an aggregate and a join over the edges, hot nodes are reduced
before the shuffle and their joins may be split by adaptive execution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import parts_for, stored

EDGES_PER_PART = 500_000


def own_key(c: Column | str) -> Column:
    """The key as text. A join of an aggregate on it is shuffled anew instead of reusing the
    aggregate's partitions, which adaptive execution could not split for a hot key."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _with_smallest(edges: DataFrame) -> DataFrame:
    """The edges with m: the smallest node among u and its neighbours v."""
    low = edges.groupBy("u").agg(F.min("v").alias("m")).select(own_key("u").alias("w"), F.least("u", "m").alias("m"))
    return edges.join(low, own_key("u") == F.col("w")).select("u", "v", "m")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected ``edges`` (u, v: long) that has a
    smaller one in its component: the root is the smallest."""
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    parts = parts_for(now.sparkSession, now.count(), EDGES_PER_PART)  # no step makes more edges than 3 to an edge
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_with_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "large-star", parts)
        small = _with_smallest(large).select(F.inline(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))))
        now = stored(small.where("u <> v").distinct(), "small-star", parts)
        # Finished when every node has one edge and it leads to a root: no node stands on both sides or twice.
        sides = now.groupBy("u").agg(F.count("*").alias("n")).select(F.col("u").alias("x"), "n", F.lit(0).alias("root"))
        sides = sides.unionAll(now.select(F.col("v").alias("x"), F.lit(0).cast("long").alias("n"), F.lit(1).alias("root")))
        bad = sides.groupBy("x").agg(F.max("n").alias("n"), F.max("root").alias("root")).where("n > 1 or (n = 1 and root = 1)")
        if bad.isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
