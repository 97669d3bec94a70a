"""The four-level cascade as one lazy plan, and as stored tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lithosense.constants import ZERO_THRESHOLD
from lithosense.functions.times import day_of, week_of
from lithosense.operators import rollup as R


@dataclass(frozen=True)
class Rules:
    """What differs between sensor and station data."""

    kind: str
    threshold: float | None
    null_std: str
    week_end: str


TEMPERATURE = Rules("temperature", ZERO_THRESHOLD, "propagate", "data")
WEATHER = Rules("weather", None, "zero", "calendar")


def rules_for(kind: str, threshold: float | None = None) -> Rules:
    base = {"temperature": TEMPERATURE, "weather": WEATHER}[kind]
    return base if threshold is None else Rules(base.kind, threshold, base.null_std, base.week_end)


def keep(df: DataFrame, rules: Rules) -> DataFrame:
    return R.savable(df, rules.kind, rules.threshold or ZERO_THRESHOLD)


def cascade(readings: DataFrame, rules: Rules = TEMPERATURE) -> dict[str, DataFrame]:
    """{level: DataFrame}, each fed by the finer one, all lazy.

    Two shuffles in total for the raw-to-week chain: raw rows are combined
    map-side into 15-minute rows and shuffled by (bucket, series); those are
    shuffled once more by (series, week), a partitioning that hour, day and week
    aggregation all accept.  A (series, week) group is at most 672 rows, so it
    cannot become hot.
    """
    fifteen = keep(R.rollup_15min(readings, threshold=rules.threshold, null_std=rules.null_std), rules)
    day = day_of("timestamp")
    placed = fifteen.withColumns({"day": day, "week": week_of(day)}).repartition("series_id", "week")
    hourly = keep(R.rollup_hourly(placed, null_std=rules.null_std, carry=("day", "week")), rules)
    daily = keep(R.rollup_daily(hourly, null_std=rules.null_std, carry=("week",)), rules)
    weekly = _weekly(daily, rules)
    return {
        "15min": fifteen,
        "hourly": hourly.drop("day", "week"),
        "daily": daily.drop("week"),
        "weekly": keep(weekly, rules),
    }


def _weekly(daily: DataFrame, rules: Rules) -> DataFrame:
    """Weekly step on days that already carry their week (and its partitioning)."""
    if rules.week_end == "data":
        daily = R.valid_stats(daily, need_std=True)
    sunday = F.date_add("week_start", 6)
    out = R.named(daily.withColumnRenamed("week", "week_start").groupBy("week_start", "series_id").agg(F.max("date").alias("_last"), *R.coarse_stats(rules.null_std)))
    end = F.least(sunday, F.col("_last")) if rules.week_end == "data" else sunday
    return out.select(
        "week_start", end.alias("week_end"), "series_id", *R.STATS, (F.col("max") - F.col("min")).alias("temp_range")
    )


def level_of(finer: DataFrame, level: str, rules: Rules = TEMPERATURE) -> DataFrame:
    """One level from the stored finer one (raw readings for 15min), validity rule applied."""
    make = {
        "15min": lambda: R.rollup_15min(finer, threshold=rules.threshold, null_std=rules.null_std),
        "hourly": lambda: R.rollup_hourly(finer, null_std=rules.null_std),
        "daily": lambda: R.rollup_daily(finer, null_std=rules.null_std),
        "weekly": lambda: R.rollup_weekly(finer, null_std=rules.null_std, week_end=rules.week_end),
    }
    return keep(make[level](), rules)


def as_sensor_table(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("series_id", "sensor_id")


def as_metric_table(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("series_id", "metric_name")
