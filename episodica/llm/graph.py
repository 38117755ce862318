"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import written


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link every neighbour of a node (larger ones, or smaller ones and itself) with the least of all of them.

    Edges have a > b. The least neighbours are a table of their own, so that
    the edges of a node with very many neighbours can be split in the join.
    """
    around = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    if large:
        around = around.union(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    least = written(
        around.groupBy("node").agg(F.min("other").alias("least")).withColumn("least", F.least("node", "least")), "least"
    )
    joined = around.join(least, "node")
    if large:
        return _distinct(joined.where("other > node").select(F.col("other").alias("a"), F.col("least").alias("b")))
    others = joined.select(F.col("other").alias("a"), F.col("least").alias("b"))
    return _distinct(others.union(least.select(F.col("node").alias("a"), F.col("least").alias("b"))))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node of ``edges`` (two long columns a, b).

    Nodes without a link to another node are left out, null ends too. The
    number of rounds grows with the logarithm of the longest chain.
    """
    now = written(
        _distinct(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(
            edges.a.isNotNull() & edges.b.isNotNull()
        )),
        "edges",
    )
    before, mark = None, _mark(now)
    while mark != before:
        large = written(_star(now, large=True), "large")
        now = written(_star(large, large=False), "small")
        before, mark = mark, _mark(now)
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
