"""Connected components by alternating large-star and small-star rounds, distributed throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: two ids); component is the least id reachable.

    Links with a null end are ignored; a link from a node to itself adds nothing. The hub of a large star
    is met only by aggregates with partial sums and by sort-merge joins, which Spark splits.
    """
    edges = edges.filter("u is not null and v is not null and u <> v")
    edges = scratch.save(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        after = scratch.save(_small_star(_large_star(edges)), "stars")
        scratch.drop(edges)
        edges, was, state = after, state, _state(after)
        if state == was:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
