"""Connected components of links in a table, by rounds of large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from namewake.llm.common import save


def _least(edges: DataFrame) -> DataFrame:
    """The smallest of each node and its neighbours (edges point from ``u`` to ``v``)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return least.select(F.col("u").alias("at"), F.least("u", "m").alias("m"))


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The edges in a table, with their number and a digest, which say whether a round changed any."""
    seen = Observation()
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    kept = save(edges.observe(seen, F.count(F.lit(1)).alias("n"), total.alias("sum")), "links")
    return kept, (seen.get["n"], seen.get["sum"])


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (u, v): comp is the smallest node reachable.

    Each round brings every node nearer to its smallest one, and the number of rounds
    grows with the logarithm of the longest path. Everything stays in tables.
    """
    edges, seen = _kept(links.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_least(both), F.col("u") == F.col("at"))
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = _least(large)
        joined = large.join(least, F.col("u") == F.col("at"))
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, now = _kept(
            small.unionByName(least.select(F.col("at").alias("u"), F.col("m").alias("v"))).distinct()
        )
        if now == seen:
            break
        seen = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return stars.unionByName(stars.select(F.col("comp").alias("node"), "comp").distinct())


def near_labels(links: DataFrame) -> DataFrame:
    """(node, comp) in two steps: the smallest node within two links.

    Nodes of equal comp are connected; connected ones may still differ.
    """
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    first = _least(both)
    met = both.join(first.withColumnRenamed("at", "v"), "v").select("u", F.col("m").alias("v"))
    near = met.unionByName(first.select(F.col("at").alias("u"), F.col("m").alias("v")))
    return near.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("comp"))
