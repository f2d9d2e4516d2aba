"""Undirected graphs as edge lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def adjacency(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(vertex, neighbour) in both directions, each once."""
    both = F.array(
        F.struct(F.col(src).alias("vertex"), F.col(dst).alias("neighbour")),
        F.struct(F.col(dst).alias("vertex"), F.col(src).alias("neighbour")),
    )
    return edges.select(F.inline(both)).distinct()


def graph_size(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Vertices met, and edges as declared (repeated ones count)."""
    ends = edges.select(F.explode(F.array(src, dst)).alias("v"))
    vertices = ends.agg(F.count_distinct("v").alias("vertices"))
    declared = edges.agg(F.count(F.lit(1)).alias("edges"))
    return vertices.select("vertices", declared.scalar().alias("edges"))


def neighbours(edges: DataFrame, vertex: int, src: str = "src", dst: str = "dst") -> DataFrame:
    touching = edges.where((F.col(src) == vertex) | (F.col(dst) == vertex))
    return adjacency(touching, src, dst).where(F.col("vertex") == vertex).select("neighbour")


def has_edges(
    pairs: DataFrame, edges: DataFrame, src: str = "src", dst: str = "dst"
) -> DataFrame:
    """The asked pairs (a, b) that are joined by an edge, in either direction.

    Both sides meet by the smaller and the larger end, so an edge is there once; that it may be
    repeated does not matter to a semi join.
    """
    ends = lambda x, y: {"_low": F.least(x, y), "_high": F.greatest(x, y)}
    # least and greatest pass over a null, which is no end of an edge
    asked = pairs.where("a is not null and b is not null").withColumns(ends("a", "b"))
    known = edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(*(c.alias(n) for n, c in ends(src, dst).items()))
    return asked.join(known, ["_low", "_high"], "left_semi").drop("_low", "_high")
