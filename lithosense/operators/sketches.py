"""Distinct counts that merge: a sketch a bucket, kept as a column of a level.

A sketch has a fixed size whatever it has seen; the union of the sketches of finer buckets is
the sketch of the coarser one, so hours merge into days and days into weeks without the
readings.  With ``lg`` bits the error is about 1.04 / 2^(lg/2), and counts of up to a few
hundred are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lithosense.functions.times import bucket_start, day_of, week_of

LG = 14


def distinct_sketch(column: Column | str, lg: int = LG) -> Column:
    """Aggregate: the sketch of a column's distinct values (nulls left out)."""
    return F.hll_sketch_agg(column, lg)


def merged_sketch(column: Column | str) -> Column:
    """Aggregate: the union of sketches."""
    return F.hll_union_agg(column)


def distinct_estimate(column: Column | str) -> Column:
    return F.hll_sketch_estimate(column)


def hourly_sketches(readings: DataFrame, column: str, keys: tuple[str, ...] = ("series_id",), lg: int = LG) -> DataFrame:
    """(timestamp, keys, n, sketch) per hour; text and whole numbers are counted as they are, others as text."""
    kind = readings.schema[column].dataType.simpleString()
    value = F.col(column) if kind in ("string", "int", "bigint") else F.col(column).cast("string")
    rows = readings.select(bucket_start("timestamp", "1 hour").alias("timestamp"), *keys, value.alias("_v"))
    return rows.groupBy("timestamp", *keys).agg(F.count("_v").alias("n"), distinct_sketch("_v", lg).alias("sketch"))


def _coarser(finer: DataFrame, axis: Column, name: str, keys: tuple[str, ...]) -> DataFrame:
    rows = finer.select(axis.alias(name), *keys, "n", "sketch")
    return rows.groupBy(name, *keys).agg(F.sum("n").alias("n"), merged_sketch("sketch").alias("sketch"))


def daily_sketches(hourly: DataFrame, keys: tuple[str, ...] = ("series_id",)) -> DataFrame:
    return _coarser(hourly, day_of("timestamp"), "date", keys)


def weekly_sketches(daily: DataFrame, keys: tuple[str, ...] = ("series_id",)) -> DataFrame:
    return _coarser(daily, week_of("date"), "week_start", keys)


def with_estimate(level: DataFrame, out: str = "distinct") -> DataFrame:
    """A level with the estimate instead of the sketch."""
    return level.withColumn(out, distinct_estimate("sketch")).drop("sketch")
