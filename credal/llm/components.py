"""Connected components of an edge table, by alternating large and small stars.

Each round rewires every edge to the smallest neighbour of one of its ends
(two aggregations with map-side combining and two joins) and writes the edges
to the shared folder; rounds end when the edges no longer change. Nothing is
collected but a row count and a checksum. A hub with very many neighbours is
one aggregated row on one side of a join, whose other side Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credal.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).where("m < u")
    up = edges.select(F.col("v").alias("u"), F.col("u").alias("w"))       # u < w
    return up.join(least, "u", "left").select(F.col("w").alias("u"), F.coalesce("m", "u").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).union(rest)


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of longs, undirected → ``(node, component)``, a row for
    every node with an edge to another, ``component`` its smallest reachable
    node. Loops and nulls are ignored; repeated edges count once; no edges
    give no rows."""
    def mark(df):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .where("u > v").distinct(), "edges")
    seen = mark(now)
    while True:
        now = stored(_small_star(_large_star(now)).distinct(), "edges")
        if (to := mark(now)) == seen:
            break
        seen = to
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
