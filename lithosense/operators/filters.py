"""Filters, projections and data-quality splits.  All are narrow except the
uniqueness check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lithosense.constants import ENUMS, ZERO_THRESHOLD
from lithosense.functions.times import week_of
from lithosense.schema import AXIS


def active_filter(readings: DataFrame, threshold: float = ZERO_THRESHOLD, value: str = "value") -> DataFrame:
    """Drop readings of an inactive sensor (within ``threshold`` of zero)."""
    return readings.where(F.abs(F.col(value)) > threshold)


def valid_stats(df: DataFrame, need_std: bool = False) -> DataFrame:
    """Keep buckets with mean, min, max (and std) present and at least one reading."""
    need = ["mean", "min", "max"] + (["std", "count"] if need_std else [])
    return df.na.drop(subset=need).where(F.col("count") > 0)


def not_all_near_zero(df: DataFrame, threshold: float = ZERO_THRESHOLD) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.abs(F.col(c)) > threshold for c in ("mean", "min", "max")]))


def bucket_end(level: str) -> Column:
    """End (exclusive) of a bucket, on the level's own time axis."""
    axis = F.col(AXIS[level])
    minutes = {"15min": 15, "hourly": 60}
    if level in minutes:
        return F.timestamp_add("MINUTE", F.lit(minutes[level]), axis)
    return F.date_add(axis, 1 if level == "daily" else 7)


def closed_buckets(df: DataFrame, level: str, as_of: str) -> DataFrame:
    """Only buckets that ended at or before ``as_of`` (given, never the clock).

    The comparison is made on the bare axis, so it reaches the scan as a pushed
    filter (bucket starts are aligned, hence ``end <= as_of`` is ``start <= as_of - width``).
    """
    instant = F.lit(as_of).cast("timestamp_ntz")
    axis = F.col(AXIS[level])
    if level in ("15min", "hourly"):
        last = F.timestamp_add("MINUTE", F.lit(-15 if level == "15min" else -60), instant)
        return df.where(axis <= last)
    return df.where(axis <= F.date_sub(instant.cast("date"), 1 if level == "daily" else 7))


def last_complete_week(as_of: str) -> Column:
    """Monday of the last week that has fully ended by ``as_of``."""
    return F.date_sub(week_of(F.lit(as_of).cast("date")), 7)


def since(df: DataFrame, mark: str | Column, ts: str = "timestamp") -> DataFrame:
    """Strictly after the last processed instant."""
    mark = F.lit(mark).cast("timestamp_ntz") if isinstance(mark, str) else mark
    return df.where(F.col(ts) > mark)


def by_keys(
    df: DataFrame,
    axis: str,
    low: str,
    high: str,
    series: list[str] | DataFrame | None = None,
    key: str = "series_id",
) -> DataFrame:
    """Rows of [low, high] for a list (or a table) of series."""
    kind = df.schema[axis].dataType.simpleString()
    out = df.where(F.col(axis).between(F.lit(low).cast(kind), F.lit(high).cast(kind)))
    if isinstance(series, DataFrame):
        return out.join(series.select(key).distinct(), key, "left_semi")
    return out if series is None else out.where(F.col(key).isin(series))


def eq_filters(df: DataFrame, **equals) -> DataFrame:
    """Conjunction of equalities, e.g. ``eq_filters(df, LAYER_TYPE=1)``."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c) == v for c, v in equals.items()], F.lit(True)))


def range_scan(readings: DataFrame, series_id: str, low: str, high: str) -> DataFrame:
    """One series between two instants, in time order."""
    return (
        by_keys(readings, "timestamp", low, high, [series_id])
        .select("timestamp", "series_id", "value")
        .orderBy("timestamp")
    )


def project(df: DataFrame, columns, rename: dict[str, str] | None = None) -> DataFrame:
    return df.select(*columns).withColumnsRenamed(rename or {})


def series_slice(df: DataFrame, level: str, series_id: str, key: str = "series_id") -> DataFrame:
    """The curve of one series at one level: time axis, mean, min, max."""
    return df.where(F.col(key) == series_id).select(AXIS[level], "mean", "min", "max")


def quarantine(df: DataFrame, reasons: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split into (good, bad).  ``reasons`` maps a reason to the condition that
    raises it; the first that holds is kept in ``reason`` on the bad rows."""
    reason = F.coalesce(*[F.when(cond, F.lit(name)) for name, cond in reasons.items()])
    tagged = df.withColumn("reason", reason)
    return tagged.where(F.col("reason").isNull()).drop("reason"), tagged.where(F.col("reason").isNotNull())


def check_enums(df: DataFrame, columns: dict[str, str], required: list[str] = ()) -> DataFrame:
    """Violations per rule in one pass: ``columns`` maps a column to its enumeration
    in ``constants.ENUMS``; ``required`` columns must not be NULL."""
    rules = {
        f"enum:{c}": F.col(c).isNotNull() & ~F.col(c).isin(*ENUMS[kind]) for c, kind in columns.items()
    } | {f"required:{c}": F.col(c).isNull() for c in required}
    counts = df.agg(
        F.array(
            *[
                F.struct(F.lit(name).alias("rule"), F.count_if(cond).alias("violations"))
                for name, cond in rules.items()
            ]
        ).alias("r")
    )
    return counts.select(F.inline("r"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once (the uniqueness rule of the schema)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
