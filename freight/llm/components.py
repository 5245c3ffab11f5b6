"""Connected components of a graph given by its edges, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freight.llm.common import written


def _pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(F.col(a).alias("a"), F.col(b).alias("b"))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step.  Each vertex ties its larger (or its smaller) neighbours and itself to the smallest.

    The smallest neighbour comes from one aggregate with partial sums, so no vertex gathers its
    neighbours; a vertex with very many meets them only in a join, which adaptive execution splits.
    """
    if large:
        around = _pairs(edges, "a", "b").unionAll(_pairs(edges, "b", "a"))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    met = around.join(least, "a")
    if large:
        moved = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = met.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionAll(_pairs(least, "a", "m"))
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``vertex, component``: the smallest vertex that each vertex of an edge can reach.

    The vertices are of one type with an order.  Steps repeat until the edges stay the same, about
    log2 of the longest chain times; each result is written to the shared folder, which cuts the
    lineage.  Loops and repeated edges do no harm; no edges give no rows.
    """
    edges = _pairs(edges, a, b).where(F.col(a) != F.col(b)).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = written(edges, "edges"), None
    while True:
        edges = written(_star(_star(edges, True), False), "edges")
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component")).unionAll(
                edges.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct()
            )
        before = mark
