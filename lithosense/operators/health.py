"""Sensor health per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lithosense.functions.times import day_of


def sensor_health(
    fifteen: DataFrame,
    dim: DataFrame,
    expected_per_day: int,
    sigma: float = 3.0,
    warn: float = 80.0,
    critical: float = 50.0,
    max_anomalies: int = 3,
) -> DataFrame:
    """Capture rate, noise, anomalies and status of every active sensor and day.

    ``capture`` = readings received / expected; ``noise`` = mean 15-minute
    deviation; an anomaly is a quarter hour whose mean is more than ``sigma``
    deviations from the day's mean of means.  An active sensor without data on a
    day of the data's span is OFFLINE.  Battery and signal strength have no input
    and stay NULL.
    """
    src = fifteen.select(day_of("timestamp").alias("date"), "series_id", "mean", "std", "count")
    day = src.groupBy("date", "series_id").agg(
        F.sum("count").alias("readings"),
        F.avg("std").alias("noise"),
        F.avg("mean").alias("centre"),
        F.stddev_pop("mean").alias("spread"),
    )
    anomalies = (
        src.join(day.select("date", "series_id", "centre", "spread"), ["date", "series_id"])
        .groupBy("date", "series_id")
        .agg(F.count_if(F.abs(F.col("mean") - F.col("centre")) > sigma * F.col("spread")).alias("anomalies"))
    )
    measured = day.join(anomalies, ["date", "series_id"]).select("date", "series_id", "readings", "noise", "anomalies")

    # Every active sensor on every day of the data's span, unfolded from the
    # dimension itself: no join is needed to make the grid.
    days = fifteen.agg(F.min("timestamp").cast("date").alias("a"), F.max("timestamp").cast("date").alias("b"))
    first, last = days.select("a").scalar(), days.select("b").scalar()
    grid = dim.where(F.col("is_active")).select(
        F.col("sensor_id").alias("series_id"), F.explode(F.sequence(first, last)).alias("date")
    )
    rate = F.coalesce(F.col("readings"), F.lit(0)) / F.lit(expected_per_day) * 100
    status = (
        F.when(F.col("readings").isNull(), "OFFLINE")
        .when(F.col("capture_rate") < critical, "CRITICAL")
        .when((F.col("capture_rate") < warn) | (F.col("anomaly_count") > max_anomalies), "WARNING")
        .otherwise("GOOD")
    )
    return (
        grid.join(measured, ["date", "series_id"], "left")
        .withColumn("capture_rate", rate)
        .withColumn("anomaly_count", F.coalesce(F.col("anomalies"), F.lit(0)).cast("bigint"))
        .select(
            "date", "series_id", "capture_rate", F.col("noise").alias("noise_level"), "anomaly_count",
            F.lit(None).cast("double").alias("battery_level"), F.lit(None).cast("double").alias("signal_strength"),
            status.alias("health_status"),
        )
    )
