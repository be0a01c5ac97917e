"""Candidate pairs of buckets of any size, and the connected components of links.

A bucket of m entries has m * (m - 1) / 2 pairs. So its entries are first paired with one of them,
the pivot. Then only entries that are not connected yet are paired, which loses no link between
components. Components come from alternating large-star and small-star steps (Kiveris et al., 2014).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.store import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least node around it."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).union(others)


def components(links: DataFrame) -> DataFrame:
    """node and label, the least node of its component, of a table of links between two nodes.

    Nodes of any ordered type; a link of a node with itself or a null says nothing. Nodes without
    a link are left out. Each step is a few shuffles of the links, cut by a written table; the
    number of steps grows with the logarithm of the longest path.
    """
    a, b = links.columns
    pairs = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges = written(pairs.where("u > v").distinct(), "links")
    state = None
    while True:
        # The table itself tells whether a step has changed it: rows and a sum over all of them.
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == state or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
                edges.select("v", "v").distinct()
            )
        state = now
        larger = written(_large_star(edges).distinct(), "links")
        edges = written(_small_star(larger).distinct(), "links")


def pivoted(buckets: DataFrame, fits: str) -> DataFrame:
    """Candidate pairs of each entry of a bucket (bucket, node, n, p, and m if there is one) with the
    bucket's first."""
    more = [c for c in buckets.columns if c not in ("bucket", "node")]
    first = F.struct("n", "node", *(c for c in more if c != "n"))
    pivot = buckets.groupBy("bucket").agg(F.min(first).alias("pivot"))
    pairs = buckets.join(pivot, "bucket").select(
        F.col("pivot.node").alias("a"),
        F.col("node").alias("b"),
        *(F.col(f"pivot.{c}").alias(f"{c}_a") for c in more),
        *(F.col(c).alias(f"{c}_b") for c in more),
    )
    return pairs.where(f"a <> b and {fits}").select("a", "b").distinct()


def unconnected(buckets: DataFrame, labels: DataFrame, fits: str) -> DataFrame:
    """Candidate pairs of entries of the same bucket whose components differ."""
    own = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = (
        own.groupBy("bucket")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low <> high")
        .select("bucket")
    )
    own = written(own.join(mixed, "bucket"), "unconnected")
    names = [c for c in own.columns if c != "bucket"]
    a = own.select("bucket", *(F.col(c).alias(f"{c}_a") for c in names))
    b = own.select("bucket", *(F.col(c).alias(f"{c}_b") for c in names))
    pairs = a.join(b, "bucket").where(f"label_a < label_b and {fits}")
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
