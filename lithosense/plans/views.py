"""The warehouse views and sample reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lithosense.operators.summaries import latest
from lithosense.operators.windows import latest_per_series

# Raw fact tables that a sensor type reads from.
FACT_TYPES = ("TEMPERATURE", "PRESSURE", "STRAIN", "MOISTURE")


def tagged_readings(facts: dict[str, DataFrame]) -> DataFrame:
    """The typed raw tables as one table with a ``sensor_type`` tag."""
    parts = [df.select(F.lit(kind).alias("sensor_type"), "series_id", "timestamp", "value", "reading_id") for kind, df in facts.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def latest_readings(dim: DataFrame, facts: dict[str, DataFrame], tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Latest reading of every active sensor from the table of its type.

    One aggregation over all facts instead of two correlated look-ups per sensor
    and type.  Sensors without data, or of a type without a table, stay with NULL.
    With unique instants per sensor no tie-break is needed and the aggregation
    works on primitive buffers; ``("reading_id",)`` decides equal instants.
    """
    newest = latest_per_series(tagged_readings(facts), ("sensor_type", "series_id"), tiebreak)
    return (
        dim.where(F.col("is_active"))
        .join(newest.withColumnRenamed("series_id", "sensor_id"), ["sensor_type", "sensor_id"], "left")
        .select("sensor_id", "sensor_type", "layer", "depth", "latest_value", "latest_timestamp", "units")
    )


def current_profile(hourly: DataFrame, dim: DataFrame) -> DataFrame:
    """Hourly means of the newest hour by depth.  The newest hour is a scalar
    sub-query whose value is pushed into the scan."""
    side = dim.where(F.col("sensor_type") == "TEMPERATURE").select(F.col("sensor_id").alias("series_id"), "depth", "layer")
    return (
        hourly.where(F.col("timestamp") == latest(hourly))
        .join(side, "series_id")
        .select("depth", "layer", F.col("mean").alias("temperature"), "timestamp")
        .orderBy("depth")
    )


def current_weather(hourly: DataFrame) -> DataFrame:
    return (
        hourly.where(F.col("timestamp") == latest(hourly))
        .select(F.col("series_id").alias("metric_name"), "mean", "min", "max", "timestamp")
        .orderBy("metric_name")
    )


def weekly_temp_weather(weekly: DataFrame, weekly_weather: DataFrame, dim: DataFrame) -> DataFrame:
    """Weekly sensor statistics beside three weekly station means.

    Three left joins to one table become a pivot to one row per week and a single
    left join; the result is equal because (week, metric) is unique.
    """
    def metric(name: str, out: str):
        return F.max(F.when(F.col("series_id") == name, F.col("mean"))).alias(out)

    weather = weekly_weather.where(F.col("series_id").isin("temperature", "relative_humidity", "solar_radiation")).groupBy("week_start").agg(
        metric("temperature", "avg_air_temperature"),
        metric("relative_humidity", "avg_humidity"),
        metric("solar_radiation", "avg_solar_radiation"),
    )
    side = dim.select(F.col("sensor_id").alias("series_id"), "layer", "depth")
    return (
        weekly.join(side, "series_id")
        .join(weather, "week_start", "left")
        .select(
            "week_start", "week_end", F.col("series_id").alias("sensor_id"), "layer", "depth",
            F.col("mean").alias("avg_temperature"), F.col("min").alias("min_temperature"), F.col("max").alias("max_temperature"),
            "avg_air_temperature", "avg_humidity", "avg_solar_radiation",
        )
        .orderBy(F.desc("week_start"), "depth")
    )


def daily_sensor_vs_weather(
    hourly: DataFrame, dim: DataFrame, hourly_weather: DataFrame, low: str, high: str,
    layer: str = "ASPHALT", max_depth: float = 100.0,
) -> DataFrame:
    """Per day, the mean of shallow sensors of a layer beside the highest hourly air
    temperature and solar radiation.

    Both sides are reduced to one row per day before they meet.  Joining first, as
    the plain query does, multiplies every reading of a day by every station row
    of that day without changing the averages or maxima.
    """
    side = dim.where((F.col("layer") == layer) & (F.col("depth") < max_depth)).select(F.col("sensor_id").alias("series_id"))
    span = F.col("timestamp").between(F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz"))
    sensors = (
        hourly.where(span)
        .join(side, "series_id")
        .groupBy(F.col("timestamp").cast("date").alias("day"))
        .agg(F.avg("mean").alias("avg_sensor_temp"))
    )
    # Only days the sensors can have: prunes the station scan as well.
    first, after = F.lit(low).cast("date"), F.date_add(F.lit(high).cast("date"), 1)
    days = (F.col("timestamp") >= first.cast("timestamp_ntz")) & (F.col("timestamp") < after.cast("timestamp_ntz"))
    weather = (
        hourly_weather.where(days & F.col("series_id").isin("temperature", "solar_radiation"))
        .groupBy(F.col("timestamp").cast("date").alias("day"))
        .agg(
            F.max(F.when(F.col("series_id") == "temperature", F.col("mean"))).alias("max_air_temp"),
            F.max(F.when(F.col("series_id") == "solar_radiation", F.col("mean"))).alias("max_solar_radiation"),
        )
    )
    return sensors.join(weather, "day").orderBy("day")
