"""Connected components as rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from monthbook.llm.common import saved


def _stars(edges: DataFrame) -> DataFrame:
    """One round: hang every node's larger neighbours, then its smaller ones, on the least.

    Edges are (u, v) with u > v.  Minima are pre-aggregated before they are shuffled, and the
    joins are plain equi-joins, so a node with very many links can be split.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = (both.groupBy("u").agg(F.min("v").alias("m"))
             .select("u", F.least("u", "m").alias("m")))
    large = (both.where("v > u").join(least, "u").where("v != m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = (large.join(low, "u").where("v != m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return small.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least node reachable.

    Null ends and links from a node to itself are ignored; repeated links change nothing.
    Each round is written to the shared folder.  A round at least halves the distances, so
    ``rounds`` is far above what 2**60 nodes need; running out of rounds is an error.
    """
    state = saved(edges.where("a != b")
                  .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .distinct(), "links")
    before = None
    for _ in range(rounds):
        row = state.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v")
                                                            .cast("decimal(38,0)")).alias("h"))
        now = tuple(row.first())
        if now == before:
            return (state.select(F.col("u").alias("node"), F.col("v").alias("root"))
                    .union(state.select(F.col("v"), F.col("v")).distinct()))
        before = now
        state = saved(_stars(state), "links")
    raise RuntimeError(f"no fixed point after {rounds} rounds")
