"""The statistics cascade: readings -> 15 minutes -> hour -> day -> week.

Above 15 minutes ``mean`` is the mean of the finer means and ``std`` is the
pooled deviation (see functions.stats).  Every level is one hash aggregation
with map-side combine, so a series holding most of the rows costs one small
partial row per task and bucket, not a hot reducer.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F

from lithosense.constants import ZERO_THRESHOLD
from lithosense.functions import stats
from lithosense.functions.times import bucket_start, day_of, week_of
from lithosense.operators.filters import active_filter, not_all_near_zero, valid_stats

STATS = ("mean", "min", "max", "std", "count")


def rollup_15min(
    readings: DataFrame,
    keys: tuple[str, ...] = ("series_id",),
    threshold: float | None = ZERO_THRESHOLD,
    null_std: str = "propagate",
    width: str = "15 minutes",
) -> DataFrame:
    """Tumbling statistics of raw readings; ``std`` is the sample deviation.

    ``threshold`` drops inactive readings first (None for station metrics);
    ``null_std='zero'`` gives 0 instead of NULL for a single reading.
    """
    src = readings if threshold is None else active_filter(readings, threshold)
    bucketed = src.where(F.col("value").isNotNull()).select(bucket_start("timestamp", width).alias("timestamp"), *keys, "value")
    return _raw_stats(bucketed, keys, null_std)


def _raw_stats(bucketed: DataFrame, keys: tuple[str, ...], null_std: str) -> DataFrame:
    std = F.stddev_samp("value")
    return bucketed.groupBy("timestamp", *keys).agg(
        (F.sum("value") / F.count("value")).alias("mean"),  # shares the count's buffer
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        (std if null_std == "propagate" else F.coalesce(std, F.lit(0.0))).alias("std"),
        F.count("value").alias("count"),
    )


def rollup_15min_weather(readings: DataFrame, keys: tuple[str, ...] = ("series_id",)) -> DataFrame:
    return rollup_15min(readings, keys, threshold=None, null_std="zero")


def rollup_15min_wide(
    wide: DataFrame, channels: list[str], threshold: float | None = ZERO_THRESHOLD, null_std: str = "propagate"
) -> DataFrame:
    """Same result from a wide frame (``timestamp`` + one column per channel).

    The bucket is computed once per wide row, the cells are unfolded with their
    column number, and the number (not the name) is the grouping key; names come
    back on the few result rows.  One aggregate per channel would instead exceed
    what the JIT compiles and runs several times slower.
    """
    cells = F.array(*[F.col(f"`{c}`").cast("double") for c in channels])
    long = wide.select(bucket_start("timestamp", "15 minutes").alias("timestamp"), F.posexplode(cells).alias("series_id", "value"))
    out = _raw_stats(long.where(F.col("value").isNotNull() if threshold is None else F.abs("value") > threshold), ("series_id",), null_std)
    names = F.array(*[F.lit(c) for c in channels])
    return out.withColumn("series_id", F.get(names, F.col("series_id")))


def coarse_stats(null_std: str) -> list:
    """Aggregates from a finer level, under names that its columns do not have; see ``named``."""
    return [
        F.avg("mean").alias("_mean"), F.min("min").alias("_min"), F.max("max").alias("_max"),
        stats.pooled_std(null_std=null_std).alias("_std"), F.sum("count").alias("_count"),
    ]


def named(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({f"_{c}": c for c in STATS})


def _coarser(finer: DataFrame, group: list[str], null_std: str) -> DataFrame:
    return named(finer.groupBy(*group).agg(*coarse_stats(null_std)))


def rollup_hourly(
    fifteen: DataFrame, keys: tuple[str, ...] = ("series_id",), null_std: str = "propagate", carry: tuple[str, ...] = ()
) -> DataFrame:
    """15 minutes to hours.  ``carry`` names columns that are functions of the
    hour (day, week) and ride along as grouping keys."""
    src = fifteen.select(bucket_start("timestamp", "1 hour").alias("timestamp"), *keys, *carry, *STATS)
    return _coarser(src, ["timestamp", *keys, *carry], null_std)


def rollup_daily(
    hourly: DataFrame, keys: tuple[str, ...] = ("series_id",), null_std: str = "propagate", carry: tuple[str, ...] = ()
) -> DataFrame:
    src = hourly.select(day_of("timestamp").alias("date"), *keys, *carry, *STATS)
    return _coarser(src, ["date", *keys, *carry], null_std).withColumn("temp_range", F.col("max") - F.col("min"))


def rollup_weekly(
    daily: DataFrame,
    keys: tuple[str, ...] = ("series_id",),
    null_std: str = "propagate",
    week_end: str = "data",
) -> DataFrame:
    """Days to Monday weeks.

    ``week_end='data'`` ends a week on its last day with data and first drops
    days without a deviation (sensor rule); ``'calendar'`` always ends on Sunday
    (station rule).
    """
    src = valid_stats(daily, need_std=True) if week_end == "data" else daily
    src = src.select(week_of("date").alias("week_start"), "date", *keys, *STATS)
    out = named(src.groupBy("week_start", *keys).agg(F.max("date").alias("_last"), *coarse_stats(null_std)))
    sunday = F.date_add("week_start", 6)
    end = F.least(sunday, F.col("_last")) if week_end == "data" else sunday
    return out.select(
        "week_start", end.alias("week_end"), *keys, *STATS, (F.col("max") - F.col("min")).alias("temp_range")
    )


def pooled_std_two_pass(finer: DataFrame, group: list[str], null_std: str = "propagate") -> DataFrame:
    """Pooled deviation by centring on the group mean first.

    The same value as ``stats.pooled_std``, for groups of any size.  The groups are usually the finer buckets of one coarser bucket (4
    quarters, 24 hours or 7 days per series), so the window stays small; hash
    aggregation follows on the same partitioning, without another shuffle.
    """
    w = Window.partitionBy(*group)
    s = F.col("std") if null_std == "propagate" else F.coalesce(F.col("std"), F.lit(0.0))
    centre = F.sum(F.col("count") * F.col("mean")).over(w) / F.nullif(F.sum("count").over(w), F.lit(0))
    centred = finer.select(*group, "count", "std", s.alias("_s"), (F.col("mean") - centre).alias("_d"))
    total = F.sum("count")
    root = F.sqrt(F.sum(F.col("count") * (F.col("_s") * F.col("_s") + F.col("_d") * F.col("_d"))) / F.nullif(total, F.lit(0)))
    out = F.when(total == 0, F.lit(0.0)).otherwise(root)
    if null_std == "propagate":
        out = F.when(F.count("std") < F.count(F.lit(1)), F.lit(None).cast("double")).otherwise(out)
    else:
        out = F.when(total == 1, F.lit(0.0)).otherwise(out)
    return centred.groupBy(*group).agg(out.alias("std"), total.alias("count"))


def exact_rollup(finer: DataFrame, group: list[str]) -> DataFrame:
    """True mean and sample deviation of the raw readings behind finer buckets, for groups of any size.

    The groups' means are summed first and joined to the buckets, whose squared distances
    from them are summed then; both sums are combined map-side, so no task holds a group,
    and nothing cancels where values are far from zero.
    """
    keys = {c: f"_{c}_" for c in group}
    means = finer.groupBy(*group).agg(stats.weighted_mean().alias("_centre")).withColumnsRenamed(keys)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()])
    off = F.col("mean") - F.col("_centre")
    s2 = F.coalesce(F.col("std") * F.col("std"), F.lit(0.0))
    sums = finer.join(means, same).groupBy(*group).agg(
        F.max("_centre").alias("_mean"), F.min("min").alias("_min"), F.max("max").alias("_max"), F.sum("count").alias("_count"),
        F.sum((F.col("count") - 1) * s2 + F.col("count") * off * off).alias("_m2"),
    )
    std = F.when(F.col("_count") > 1, F.sqrt(F.col("_m2") / (F.col("_count") - 1)))
    return named(sums.withColumn("_std", std).select(*group, *[f"_{c}" for c in STATS]))


def legacy_15min(enriched: DataFrame) -> DataFrame:
    """15-minute statistics with the sensor's depth and layer in the key, no deviation."""
    return (
        enriched.select(bucket_start("timestamp", "15 minutes").alias("interval_start"), "series_id", "depth", "layer", "value")
        .groupBy("interval_start", "series_id", "depth", "layer")
        .agg(
            F.avg("value").alias("avg_temp"), F.min("value").alias("min_temp"),
            F.max("value").alias("max_temp"), F.count("value").alias("count"),
        )
    )


def day_completeness(hourly: DataFrame, required: int = 1, key: str = "series_id") -> DataFrame:
    """(date, series) with at least ``required`` distinct hours, for all days at once."""
    return (
        hourly.select(day_of("timestamp").alias("date"), key, "timestamp")
        .groupBy("date", key)
        .agg(F.count_distinct("timestamp").alias("hours"))
        .where(F.col("hours") >= required)
    )


def week_completeness(daily: DataFrame, required: int = 1, key: str = "series_id") -> DataFrame:
    return (
        daily.select(week_of("date").alias("week_start"), key, "date")
        .groupBy("week_start", key)
        .agg(F.count_distinct("date").alias("days"))
        .where(F.col("days") >= required)
    )


def savable(df: DataFrame, kind: str = "temperature", threshold: float = ZERO_THRESHOLD) -> DataFrame:
    """The validity rule applied before a level is stored."""
    out = valid_stats(df)
    return not_all_near_zero(out, threshold) if kind == "temperature" else out
