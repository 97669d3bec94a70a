"""Warehouse tables of the monitoring system."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lithosense.constants import SENSOR_PLACEMENT
from lithosense.schema import SENSOR_DIM

# --- fixed values: column names and types the warehouse schema declares -----------
_DIMENSIONS = {
    "SensorInformation": (
        "SensorID STRING, SensorType STRING, ModelNumber STRING, Orientation STRING, WheelPath STRING, "
        "Depth DECIMAL(6,1), LayerType STRING, XCoordinate DECIMAL(9,3), YCoordinate DECIMAL(9,3), "
        "ZCoordinate DECIMAL(9,3), InstallationDate TIMESTAMP_NTZ, CalibrationFormula STRING, "
        "MeasurementUnit STRING, MinValue DECIMAL(9,3), MaxValue DECIMAL(9,3), Accuracy DECIMAL(9,3), "
        "Description STRING, IsActive BOOLEAN, CreatedAt TIMESTAMP_NTZ, UpdatedAt TIMESTAMP_NTZ"
    ),
    "ProjectInformation": (
        "ProjectID STRING, ProjectName STRING, Location STRING, Latitude DECIMAL(9,6), Longitude DECIMAL(9,6), "
        "PavementAge DECIMAL(5,2), ConstructionDate TIMESTAMP_NTZ, PavementType STRING, ClimateRegion STRING, "
        "AnnualFreezingIndex DECIMAL(9,2), AnnualPrecipitation DECIMAL(9,2), AnnualAverageTemperature DECIMAL(5,2), "
        "AADT INT, AADTT INT, Description STRING, ContactInformation STRING, CreatedAt TIMESTAMP_NTZ, "
        "UpdatedAt TIMESTAMP_NTZ"
    ),
    "SystemStatus": (
        "StatusID INT, StatusType STRING, LastRunTimestamp TIMESTAMP_NTZ, LastProcessedTimestamp TIMESTAMP_NTZ, "
        "Status STRING, Message STRING, UpdatedAt TIMESTAMP_NTZ"
    ),
    "ArchiveInfo": (
        "ArchiveID INT, IntervalStart TIMESTAMP_NTZ, IntervalEnd TIMESTAMP_NTZ, ArchiveDate TIMESTAMP_NTZ, "
        "ArchiveFilePath STRING, FileSize BIGINT, ArchiveStatus STRING, Notes STRING, CreatedAt TIMESTAMP_NTZ"
    ),
    "sensor_metadata": SENSOR_DIM + ", updated_at TIMESTAMP_NTZ",
}
_STATION = (
    "Temperature DECIMAL(5,2), DewPoint DECIMAL(5,2), RelativeHumidity DECIMAL(5,2), PressureStation DECIMAL(6,2), "
    "PressureSea DECIMAL(6,2), WindDirection STRING, WindDirectionDegrees INT, WindSpeed DECIMAL(5,2), "
    "WindGust DECIMAL(5,2), Windchill DECIMAL(5,2), Humidex DECIMAL(5,2), Visibility DECIMAL(7,2), "
    "HealthIndex DECIMAL(5,2), CloudCover DECIMAL(5,2), SolarRadiation DECIMAL(7,2), MaxTempPastHour DECIMAL(5,2), "
    "MinTempPastHour DECIMAL(5,2), DataSource STRING, RecordedAt TIMESTAMP_NTZ"
)
_DAILY = "MinTimestamp TIMESTAMP_NTZ, MaxTimestamp TIMESTAMP_NTZ, DayNightDelta DECIMAL(5,2)"
_WEEKLY = (
    "LayerType STRING, Depth DECIMAL(6,1), MinTimestamp TIMESTAMP_NTZ, MaxTimestamp TIMESTAMP_NTZ, "
    "WeekdayAvgTemp DECIMAL(5,2), WeekendAvgTemp DECIMAL(5,2)"
)
_GRADIENT = (
    "Timestamp TIMESTAMP_NTZ, AsphaltMeanTemp DECIMAL(5,2), BaseMeanTemp DECIMAL(5,2), SubbaseMeanTemp DECIMAL(5,2), "
    "SubgradeMeanTemp DECIMAL(5,2), AsphaltToBaseGradient DECIMAL(6,3), BaseToSubbaseGradient DECIMAL(6,3), "
    "SubbaseToSubgradeGradient DECIMAL(6,3), SurfaceToBottomGradient DECIMAL(6,3), MaxDailyGradient DECIMAL(6,3), "
    "MaxGradientTimestamp TIMESTAMP_NTZ, DiurnalVariationSurface DECIMAL(5,2), DiurnalVariationBase DECIMAL(5,2), "
    "IntervalEnd TIMESTAMP_NTZ, ProcessedAt TIMESTAMP_NTZ"
)
_HEALTH = (
    "Timestamp TIMESTAMP_NTZ, SensorID STRING, DataCaptureRate DECIMAL(5,2), NoiseLevel DECIMAL(5,2), AnomalyCount INT, "
    "BatteryLevel DECIMAL(5,2), SignalStrength DECIMAL(5,2), FailureFlags INT, HealthStatus STRING, Notes STRING, "
    "ProcessedAt TIMESTAMP_NTZ"
)
_RAW_VALUES = {
    "RawTemperatureData": "TemperatureValue DECIMAL(5,2)",
    "StrainData": "StrainValue DECIMAL(9,3)",
    "PressureData": "PressureValue DECIMAL(9,3)",
    "MoistureData": "MoistureValue DECIMAL(9,3), RawValue DECIMAL(9,3)",
}


def _stats(decimal: str, extra: str = "") -> str:
    names = [f"{s}Value {decimal}" for s in ("Mean", "Min", "Max", "StdDev")]
    return ", ".join(names + ([extra] if extra else []) + ["ReadingCount INT"])


def table_columns() -> dict[str, str]:
    """Column list of every table.  Facts carry a ``Day`` column, the partition that
    stands in for the time indexes of the original schema."""
    tables = dict(_DIMENSIONS)
    for name, value in _RAW_VALUES.items():
        tables[name] = f"ReadingID BIGINT, Timestamp TIMESTAMP_NTZ, SensorID STRING, {value}"
    tables["RawWeatherStationData"] = f"ReadingID BIGINT, Timestamp TIMESTAMP_NTZ, {_STATION}"
    end = "IntervalEnd TIMESTAMP_NTZ, ProcessedAt TIMESTAMP_NTZ"
    sensor = "AggregateID BIGINT, Timestamp TIMESTAMP_NTZ, SensorID STRING"
    for name, extra in (("TempData15Min", ""), ("TempDataHourly", ""), ("TempDataDaily", _DAILY), ("TempDataWeekly", _WEEKLY)):
        span = "TempRange DECIMAL(5,2)" if extra else ""
        tables[name] = ", ".join(p for p in (sensor, _stats("DECIMAL(5,2)", span), extra, end) if p)
    axes = {
        "WeatherData15Min": "Timestamp TIMESTAMP_NTZ", "WeatherDataHourly": "Timestamp TIMESTAMP_NTZ",
        "WeatherDataDaily": "Date DATE", "WeatherDataWeekly": "WeekStart DATE, WeekEnd DATE",
    }
    for name, axis in axes.items():
        span = "ValueRange DECIMAL(9,2)" if "DATE" in axis else ""
        tables[name] = f"AggregateID BIGINT, {axis}, MetricName STRING, {_stats('DECIMAL(9,2)', span)}, ProcessedAt TIMESTAMP_NTZ"
    tables["TemperatureGradientWeekly"] = f"GradientID BIGINT, {_GRADIENT}"
    tables["SensorHealthMonitoring"] = f"HealthID BIGINT, {_HEALTH}"
    return tables


def _clustering(columns: str, buckets: int) -> str:
    names = [c.split()[0] for c in columns.replace("DECIMAL(5,2)", "DECIMAL").replace("DECIMAL(9,2)", "DECIMAL").replace("DECIMAL(9,3)", "DECIMAL").split(",")if c.strip()]
    if "SensorID" not in names:
        return ""
    order = [c for c in ("SensorID", "Timestamp") if c in names]
    return f"CLUSTERED BY (SensorID) SORTED BY ({', '.join(order)}) INTO {buckets} BUCKETS "


def create_schema(spark: SparkSession, database: str, root: str | None = None, buckets: int | None = None) -> list[str]:
    """Create the database and its tables if they are missing; returns their names.

    With ``buckets`` fact tables of sensors are clustered by sensor and sorted by sensor and
    time within each day, so that joins and windows by sensor need no shuffle.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, columns in table_columns().items():
        fact = name not in _DIMENSIONS
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}{', Day DATE' if fact else ''}) USING parquet "
            + ("PARTITIONED BY (Day) " if fact else "")
            + (_clustering(columns, buckets) if fact and buckets else "")
            + (f"LOCATION '{root}/{name}'" if root else "")
        )
    return sorted(table_columns())


def sensor_dimension(spark: SparkSession) -> DataFrame:
    """The known sensors (one row each), layer names in upper case."""
    rows = spark.createDataFrame(list(SENSOR_PLACEMENT), "sensor_id STRING, depth DOUBLE, layer STRING, location STRING")
    kind = F.when(F.col("layer") == "ASPHALT", "Thermistor").otherwise("Temperature probe")
    return rows.select(
        "sensor_id",
        F.lit("TEMPERATURE").alias("sensor_type"),
        F.concat(kind, F.lit(" in "), F.lower("layer"), F.lit(" layer")).alias("description"),
        F.lit("°C").alias("units"),
        "depth", "layer", "location",
    )


def _too_large(df: DataFrame):
    """First statistic of a row that its DECIMAL(5,2) column cannot hold, else NULL."""
    names = [c for c in ("mean", "min", "max", "std", "temp_range") if c in df.columns]
    return F.coalesce(*[F.when(F.abs(F.round(c, 2)) >= 1000, F.lit(f"{c} out of range")) for c in names])


def warehouse_rejects(df: DataFrame) -> DataFrame:
    """Rows that ``to_warehouse_rollup`` leaves out, with the ``reason``."""
    return df.withColumn("reason", _too_large(df)).where(F.col("reason").isNotNull())


def to_warehouse_rollup(df: DataFrame, level: str, processed_at: str) -> DataFrame:
    """A sensor roll-up in the column names and decimals of the warehouse table.
    Values are computed in DOUBLE; decimals appear only here, at the sink.  Rows with a
    value that the table cannot hold are left out whole; store ``warehouse_rejects`` beside it."""
    df = df.where(_too_large(df).isNull())
    axis = {"15min": "timestamp", "hourly": "timestamp", "daily": "date", "weekly": "week_start"}[level]
    start = F.col(axis).cast("timestamp_ntz")
    end = {
        "15min": F.timestamp_add("MINUTE", F.lit(15), start), "hourly": F.timestamp_add("HOUR", F.lit(1), start),
        "daily": F.timestamp_add("DAY", F.lit(1), start), "weekly": F.timestamp_add("DAY", F.lit(6), start),
    }[level]
    two = lambda c: F.col(c).cast("decimal(5,2)")
    return df.select(
        start.alias("Timestamp"), F.col("series_id").alias("SensorID"),
        two("mean").alias("MeanValue"), two("min").alias("MinValue"), two("max").alias("MaxValue"), two("std").alias("StdDevValue"),
        *([two("temp_range").alias("TempRange")] if level in ("daily", "weekly") else []),
        F.col("count").cast("int").alias("ReadingCount"),
        end.alias("IntervalEnd"), F.lit(processed_at).cast("timestamp_ntz").alias("ProcessedAt"), start.cast("date").alias("Day"),
    )
