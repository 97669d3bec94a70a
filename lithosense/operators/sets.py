"""Set operations, ordering and top-n."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def stack(*frames: DataFrame) -> DataFrame:
    """Frames on top of each other; a column one lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_dates(*columns: tuple[DataFrame, str], name: str = "day") -> DataFrame:
    """Distinct values of several tables' date columns.  Each side is made distinct
    before the union, so only distinct values cross the shuffle."""
    parts = [df.select(F.col(c).alias(name)).distinct() for df, c in columns]
    return reduce(lambda a, b: a.union(b), parts).distinct()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def top_n(df: DataFrame, by: list, n: int) -> DataFrame:
    """First n rows by a total order (per-task top-n, then one merge of n rows each)."""
    return df.orderBy(*by).limit(n)


def ranked_pairs(rows: DataFrame, name: str, score: str, n: int = 100) -> DataFrame:
    """All unordered pairs of the ``n`` best rows (a report of n·(n-1)/2 rows), better one first."""
    top = rows.orderBy(F.desc(score), name).limit(n)
    best = F.array_sort(F.collect_list(F.struct((-F.col(score)).alias("order"), F.col(name).alias("name"))))
    listed = top.agg(best.alias("all"))
    one = listed.select("all", F.posexplode("all").alias("i", "a"))
    return one.select(
        F.col("a.name").alias("first"),
        F.explode(F.slice("all", F.col("i") + 2, F.size("all"))).alias("b"),
    ).select("first", F.col("b.name").alias("second"))
