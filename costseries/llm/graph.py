"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costseries.session import landed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every edge points from the larger node ``u`` to the smaller ``v``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame):
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return edges.agg(F.count(F.lit(1)), total).first()


def components(links: DataFrame) -> DataFrame:
    """``(u, v)`` links of comparable, non-null ids -> ``(node, root)`` with the smallest id of each component.

    Only nodes with a link to another node appear. Every round is landed in the shared folder, so a lost
    executor repeats at most one round. The number of rounds grows with the logarithm of the
    component size, and no step gathers a component: hubs are reduced by partial aggregates.
    """
    edges = landed(
        links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    state = _state(edges)
    while state[0]:
        edges = landed(_small_star(_large_star(edges)), "stars")
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        edges.select("v", "v").distinct()
    )
