"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import keep
from closebook.session import Scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first())


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) of every node on some edge.

    Self-loops, repeated edges and either direction are allowed; edges with a null end count as
    absent. An empty table of edges gives an empty result. Nodes may be of any type that can be
    ordered. Every round writes its edges to the shared folder, so lineage stays short; the minima
    are written as well, so that a hub's join is one that adaptive execution can split.
    """
    a, b = F.col(left), F.col(right)
    start = edges.filter(a != b).select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).distinct()
    with Scratch(edges.sparkSession) as scratch:
        pairs = scratch.keep(start, "llm-edges")
        state, before = _state(pairs), None
        while state != before:
            both = pairs.select(F.col("high").alias("node"), F.col("low").alias("other")).union(
                pairs.select(F.col("low").alias("node"), F.col("high").alias("other"))
            )
            lowest = scratch.keep(both.groupBy("node").agg(F.min("other").alias("least")), "llm-large")
            large = (
                both.filter("other > node")
                .join(lowest, "node")
                .select(F.col("other").alias("node"), F.least("least", "node").alias("other"))
                .distinct()
            )
            large = scratch.keep(large, "llm-stars")
            lowest = scratch.keep(large.groupBy("node").agg(F.min("other").alias("least")), "llm-small")
            small = large.join(lowest, "node").filter(F.col("other") != F.col("least"))
            small = small.select(F.col("other").alias("high"), F.col("least").alias("low"))
            pairs = scratch.keep(
                small.union(lowest.select(F.col("node").alias("high"), F.col("least").alias("low"))).distinct(),
                "llm-edges",
            )
            state, before = _state(pairs), state
        found = pairs.select(F.col("high").alias("node"), F.col("low").alias("component"))
        roots = pairs.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
        return keep(found.union(roots), "components")
