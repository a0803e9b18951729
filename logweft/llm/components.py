"""Connected components of a graph, by alternating large and small stars (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweft.session import cut_lineage


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b) with b < a, hung on the smallest neighbour of each node.

    Large: all greater neighbours of a node are hung on its smallest one.  Small: the smaller ones and itself are.
    """
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = joined.select(F.explode(F.array(F.struct(F.col("a"), F.col("least").alias("b")),
                                              F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("e")).select("e.*")
    return out.where("b < a").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of all nodes of the undirected ``links`` (a, b); the label is the component's smallest node.

    Every round is written to the checkpoint folder.  Rounds grow with the logarithm of the longest chain.
    """
    edges = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(edges)
    while mark[0]:
        edges = cut_lineage(_star(_star(edges, large=True), large=False))
        last, mark = mark, _mark(edges)
        if mark == last:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
