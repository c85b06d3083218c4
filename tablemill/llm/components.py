"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_000_007).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for every node of ``edges`` (``a, b``).

    Nulls and loops are left out. Each round hooks neighbours to the smallest one known and is written to
    the shared folder; minima are aggregated before they are joined, so that a hub of any degree is split
    like any other skewed join. Rounds grow with the logarithm of the longest chain.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.least(F.first("a"), F.min("b")).alias("m"))
        large = both.join(least, F.col("a") == F.col("n")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        joined = large.join(least, F.col("a") == F.col("n"))
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(joined.select("a", F.col("m").alias("b")))
        edges = materialize(small.distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    parts = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return parts.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
