"""Connected components of a set of links, by rounds of small joins on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lyceum.session import scratch_path


def nearest(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("low"))


def large_star(links: DataFrame) -> DataFrame:
    """Neighbours above a node are linked to the smallest node next to it."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = nearest(both).select("a", F.least("a", "low").alias("low"))
    return both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """A node and its neighbours below it are linked to the smallest of them."""
    low = nearest(links)
    moved = links.join(low, "a").filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b"))).distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each linked node can reach, for links (a, b).

    Alternates large and small stars until no link changes; then every node points at its smallest.  Each
    round is written to the shared folder, which cuts the lineage.  Nodes without links have no row, null
    ends are no links, and no links give no rows."""
    now = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before = None
    while True:
        path = scratch_path(spark, "links")
        small_star(large_star(now)).write.parquet(path)
        now = spark.read.parquet(path)
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = state
