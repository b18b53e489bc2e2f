"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strata.llm.common import discard, materialise


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Link a node's larger (or its smaller) neighbours to the least of them all."""
    if larger:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    met = near.join(least, "a")
    moved = met.filter(F.col("b") > F.col("a")) if larger else met
    out = moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not larger:
        out = out.unionByName(least.select("a", F.col("least").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of an edge; component is its least node.

    ``edges`` has the longs a and b. A step rewrites every edge to a smaller
    neighbour; the fixed point is one star for each component. Least
    neighbours are aggregated before the shuffle, and the joins that send them
    back are ordinary ones, which adaptive execution splits at a hot node.
    """
    edges, state = _written(edges.select("a", "b").filter("a <> b").distinct())
    before = None
    while state != before:
        before, last = state, edges
        edges, state = _written(_stars(_stars(edges, True), False))
        discard(last)
    least = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(least)


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a table, and what tells two tables of edges apart."""
    seen = Observation()
    sums = [F.sum(F.hash(*c).cast("long")).alias(n) for n, c in (("ab", ("a", "b")), ("ba", ("b", "a")))]
    table = materialise(edges.observe(seen, F.count(F.lit(1)).alias("n"), *sums), "edges")
    return table, tuple(seen.get[k] for k in ("n", "ab", "ba"))
