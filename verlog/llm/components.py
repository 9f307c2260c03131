"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is two keyed aggregates and joins over the edges; its result is
written to the shared work folder, so lineage stays one round deep. The rounds
end when the edges no longer change: every edge then leads from a node to the
smallest node of its component. Self-loops, repeated and reversed edges and an
empty table are fine; edges with a null end are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verlog.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.join(least, "u").where("v > u").select(F.col("m").alias("u"), "v")
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    moved = edges.join(least, "v").where("u <> m").select(F.col("m").alias("u"), F.col("u").alias("v"))
    return moved.unionByName(least.select(F.col("m").alias("u"), "v")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge; ``root`` is the smallest node of its component."""
    edges = stage(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
                  .distinct(), "components")
    before = _state(edges)
    while before[0]:
        edges = stage(_small_star(_large_star(edges)), "components")
        now = _state(edges)
        if now == before:
            break
        before = now
    return (edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
            .unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("root"))).distinct())
