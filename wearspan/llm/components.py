"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearspan.llm.frames import saved


def large_star(edges: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the smallest node around it."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """Each node ties itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b")))


def sized(df: DataFrame, rows: int, per_task: int = 100_000) -> DataFrame:
    """At most one task for every `per_task` of the known number of rows."""
    return df.coalesce(max(1, -(-rows // per_task)))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of `edges` (a, b); the component is its smallest node.

    Each round replaces the edges by stars around smaller nodes and is written to the shared folder. The
    number of rounds grows with the logarithm of the node count; a hub is a join key that Spark can split.
    NULL ends and loops are ignored. No edges: no rows.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = saved(ordered, "edges")
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    before = current.agg(mark).first()[0]
    while before[0]:
        n = before[0]  # a round makes no more edges than twice this
        current = saved(sized(small_star(sized(large_star(current), 2 * n)).distinct(), 2 * n), "edges")
        after = current.agg(mark).first()[0]
        if after == before:
            break
        before = after
    roots = current.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
