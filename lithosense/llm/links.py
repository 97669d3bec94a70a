"""Connected components of a table of links, without bringing links or labels to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lithosense.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the smallest id reachable) for every id in ``links(a, b)``.

    Rounds of two steps: every id's larger neighbours move to its smallest neighbour, then
    its smaller neighbours do.  The links end as stars around the smallest ids.  The number
    of rounds grows with the logarithm of the ids.  Each round is a written table.
    """
    edges = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links")
    while not _stars(edges):
        edges = written(_smaller_step(_larger_step(edges)), "links")
    roots = edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("id"), F.col("a").alias("component")).unionByName(roots)


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (``id, component``) after more ``links(a, b)``; ids without a label are components of their own.

    Only links between components go through the rounds; without any the labels stay.
    """
    of = lambda side, name: labels.select(F.col("id").alias(side), F.col("component").alias(name))
    named = links.join(of("a", "p"), "a", "left").join(of("b", "q"), "b", "left")
    ends = named.select(F.coalesce("p", "a").alias("a"), F.coalesce("q", "b").alias("b")).filter("a <> b")
    ends = written(ends.distinct(), "component-links")
    if ends.isEmpty():
        return labels
    joined = components(ends)
    moved = labels.join(joined.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left")
    new = joined.join(labels.select("id"), "id", "left_anti")
    return written(moved.select("id", F.coalesce("to", "component").alias("component")).unionByName(new.select("id", "component")), "labels")


def _stars(edges: DataFrame) -> bool:
    """Whether every id is either a smallest one or linked with one of those only."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(0).alias("up")), F.struct(F.col("b").alias("id"), F.lit(1).alias("up")))).alias("end"))
    each = ends.groupBy("end.id").agg(F.sum("end.up").alias("up"), F.min("end.up").alias("least"))
    return each.filter("up > 1 OR (up = 1 AND least = 0)").isEmpty()


def _larger_step(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()


def _smaller_step(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).filter("a < b").distinct()
