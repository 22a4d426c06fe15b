"""Connected components of a graph kept as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailtrim.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` of every node with an edge; a component is named by its smallest id.

    ``edges`` has columns ``a, b``. Each round links the neighbours of every node to the smallest
    node among them, first the larger neighbours, then the smaller ones, until only stars are left.
    The table of edges never grows; it is written anew each round.
    """
    edges = _ordered(edges)
    state = None
    while True:
        edges = saved(_small_star(_large_star(edges)), "edges")
        found = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, the larger node first."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return _ordered(
        both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("a").agg(F.min("b").alias("low"))
    linked = edges.join(lowest, "a").select("b", "low").withColumnsRenamed({"b": "a", "low": "b"})
    return _ordered(linked.unionAll(lowest.withColumnRenamed("low", "b")))
