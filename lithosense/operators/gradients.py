"""Statistics the warehouse schema declares: extreme times, day/night and
weekday/weekend contrasts, layer gradients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lithosense.constants import LAYERS
from lithosense.functions.times import day_of, week_of


def extreme_times(finer: DataFrame, bucket: Column, name: str, key: str = "series_id") -> DataFrame:
    """Earliest instant of the lowest minimum and of the highest maximum per bucket."""
    src = finer.select(bucket.alias(name), key, "timestamp", "min", "max")
    return src.groupBy(name, key).agg(
        F.min_by("timestamp", F.struct("min", "timestamp")).alias("min_timestamp"),
        F.min_by("timestamp", F.struct(-F.col("max"), F.col("timestamp"))).alias("max_timestamp"),
    )


def is_day(ts: Column, first: int = 6, last: int = 17) -> Column:
    return F.hour(ts).between(first, last)


def day_night_delta(hourly: DataFrame, key: str = "series_id", first: int = 6, last: int = 17) -> DataFrame:
    """Mean of the daytime hours minus mean of the others, per day."""
    day = is_day(F.col("timestamp"), first, last)
    return (
        hourly.select(day_of("timestamp").alias("date"), key, "mean", day.alias("day"))
        .groupBy("date", key)
        .agg((F.avg(F.when(F.col("day"), F.col("mean"))) - F.avg(F.when(~F.col("day"), F.col("mean")))).alias("day_night_delta"))
    )


def weekday_weekend_avg(daily: DataFrame, key: str = "series_id") -> DataFrame:
    work = F.weekday("date") < 5
    return (
        daily.withColumn("week_start", week_of("date"))
        .groupBy("week_start", key)
        .agg(
            F.avg(F.when(work, F.col("mean"))).alias("weekday_avg"),
            F.avg(F.when(~work, F.col("mean"))).alias("weekend_avg"),
        )
    )


def layer_gradient(stats: DataFrame, dim: DataFrame, axis: str, layers: tuple[str, ...] = LAYERS) -> DataFrame:
    """Mean of each layer and °C per metre between neighbours and top to bottom.

    Depths are the mean depth (mm) of the sensors that have data on that axis value.
    """
    side = dim.select(F.col("sensor_id").alias("series_id"), "layer", "depth")
    wide = stats.select(axis, "series_id", "mean").join(side, "series_id").groupBy(axis).agg(
        *[F.avg(F.when(F.col("layer") == n, F.col("mean"))).alias(f"{n.lower()}_mean") for n in layers],
        *[F.avg(F.when(F.col("layer") == n, F.col("depth"))).alias(f"{n.lower()}_depth") for n in layers],
    )

    def between(upper: str, lower: str) -> Column:
        metres = (F.col(f"{lower}_depth") - F.col(f"{upper}_depth")) / 1000
        return (F.col(f"{upper}_mean") - F.col(f"{lower}_mean")) / F.nullif(metres, F.lit(0.0))

    low = [n.lower() for n in layers]
    steps = [(a, b, f"{a}_to_{b}") for a, b in zip(low, low[1:])] + [(low[0], low[-1], "surface_to_bottom")]
    return wide.select(axis, *[f"{n}_mean" for n in low], *[between(a, b).alias(n) for a, b, n in steps])


def max_daily_gradient(daily: DataFrame, dim: DataFrame) -> DataFrame:
    """Per week, the surface-to-bottom gradient of largest size and its day."""
    per_day = layer_gradient(daily, dim, "date").select("date", "surface_to_bottom").where(F.col("surface_to_bottom").isNotNull())
    order = F.struct(-F.abs(F.col("surface_to_bottom")), F.col("date"))
    return per_day.groupBy(week_of("date").alias("week_start")).agg(
        F.min_by("surface_to_bottom", order).alias("max_daily_gradient"),
        F.min_by("date", order).alias("max_gradient_date"),
    )


def diurnal_variation(hourly: DataFrame, dim: DataFrame, layers: tuple[str, ...] = ("ASPHALT", "BASE")) -> DataFrame:
    """Average day/night difference per week of the named layers."""
    side = dim.select(F.col("sensor_id").alias("series_id"), "layer").where(F.col("layer").isin(*layers))
    return (
        day_night_delta(hourly)
        .join(side, "series_id")
        .groupBy(week_of("date").alias("week_start"))
        .agg(*[F.avg(F.when(F.col("layer") == n, F.col("day_night_delta"))).alias(f"{n.lower()}_diurnal") for n in layers])
    )


def gradient_weekly(hourly: DataFrame, daily: DataFrame, weekly: DataFrame, dim: DataFrame) -> DataFrame:
    """The weekly gradient table of the warehouse, one row per week."""
    return (
        layer_gradient(weekly, dim, "week_start")
        .join(max_daily_gradient(daily, dim), "week_start", "left")
        .join(diurnal_variation(hourly, dim), "week_start", "left")
        .withColumn("interval_end", F.date_add("week_start", 6))
    )


def interval_end(df: DataFrame, level: str) -> DataFrame:
    """End of each bucket: exclusive instant below a day, last calendar day of a
    week, next midnight of a day."""
    end = {
        "15min": lambda: F.timestamp_add("MINUTE", F.lit(15), F.col("timestamp")),
        "hourly": lambda: F.timestamp_add("HOUR", F.lit(1), F.col("timestamp")),
        "daily": lambda: F.date_add("date", 1).cast("timestamp_ntz"),
        "weekly": lambda: F.date_add("week_start", 6),
    }[level]()
    return df.withColumn("interval_end", end)
