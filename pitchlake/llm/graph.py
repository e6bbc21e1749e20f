"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.store import written


def _least(edges: DataFrame) -> DataFrame:
    """For each node the smallest of itself and its neighbours; written, so that its join can be split."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return written(least.select("u", F.least("u", "m").alias("m")), "graph-least")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.inline(F.array(
        F.struct(F.col("u"), F.col("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    )))


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every node of the edges (u, v): root is the smallest id of its component.

    Each round links every node's larger neighbours to its smallest one (large star), then its smaller
    ones (small star); the rounds grow with the logarithm of a component's width. Edges are written
    between steps, and nothing of the graph but a sum for the end test reaches the driver.
    """
    state = written(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct(), "graph-edges")
    before = None
    while True:
        wide = _both_ways(state)
        large = wide.join(_least(wide), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "graph-large")
        least = _least(large)
        small = large.join(least, "u").select(F.col("v").alias("a"), F.col("u"), F.col("m"))
        small = small.select(F.inline(F.array(
            F.struct(F.col("a").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v"))
        )))
        state = written(small.where("u <> v").distinct(), "graph-edges")
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = state.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("root"))
    return state.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots)
