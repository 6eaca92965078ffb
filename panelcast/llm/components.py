"""Connected components of a graph that is too large for one machine: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")) \
        .filter("u > v").distinct()


def connected(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for the nodes of ``links`` (columns ``a, b``, any ordered type).

    Links may repeat, loop or have either direction; those with a NULL end are
    left out.  Each round is written to the shared folder.  A hub's rows are
    pre-aggregated, and its join is one that Spark can split.
    """
    edges = materialize(links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        # count and a sum that does not depend on the order of rows
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        edges = materialize(_small_star(_large_star(edges)), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
