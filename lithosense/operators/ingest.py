"""From decoded channels, sensor exports and station records to readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lithosense.constants import (
    SECONDS_PER_SAMPLE,
    TEMPERATURE_KEYWORDS,
    TEMPERATURE_SENSORS,
    WEATHER_METRICS,
)
from lithosense.functions import times
from lithosense.functions.numeric import to_double
from lithosense.functions.text import contains_any

CHANNEL = ("file", "grp", "channel")


# --- channels ------------------------------------------------------------------
def channel_lengths(samples: DataFrame) -> DataFrame:
    """Points per channel, how many of them are numbers, and the value range.

    Numeric buffers only, so this is a hash aggregation; ties between clocks are
    later broken by the group name.
    """
    value = F.col("value").try_cast("double")
    return samples.groupBy(*CHANNEL).agg(
        F.count(F.lit(1)).alias("n"), F.count(value).alias("numeric"), F.min(value).alias("low"), F.max(value).alias("high")
    )


def with_ordinals(lengths: DataFrame, meta: DataFrame) -> DataFrame:
    """Lengths with each channel's place in its file (one row per channel, so a small join)."""
    places = meta.groupBy(*CHANNEL).agg(F.min("ordinal").alias("ordinal"))
    return lengths.join(places, list(CHANNEL), "left")


def pick_time_channel(lengths: DataFrame, name: str = "Time") -> DataFrame:
    """Per file, the channel called ``name`` with the most points; of equals the first in the
    file (by ``ordinal`` if known, then by group name)."""
    facts = [c for c in ("grp", "channel", "n", "low", "high", "ordinal") if c in lengths.columns]
    place = [F.coalesce("ordinal", F.lit(2**31 - 1)).alias("place")] if "ordinal" in facts else []
    return (
        lengths.where(F.col("channel") == name)
        .groupBy("file")
        .agg(F.min_by(F.struct(*facts), F.struct((-F.col("n")).alias("m"), *place, "grp")).alias("t"))
        .select("file", "t.*")
    )


def last_of_name(lengths: DataFrame) -> DataFrame:
    """Of a file's channels with one name in several groups, the last in the file."""
    if "ordinal" not in lengths.columns:
        return lengths
    last = lengths.groupBy("file", "channel").agg(F.max_by("grp", F.struct(F.coalesce("ordinal", F.lit(-1)).alias("place"), "grp")).alias("grp"))
    return lengths.join(last, list(CHANNEL), "left_semi")


def drop_bad_channels(lengths: DataFrame, name: str = "Time") -> DataFrame:
    """Value channels that have points, all of them numeric."""
    return lengths.where((F.col("channel") != name) & (F.col("n") > 0) & (F.col("numeric") == F.col("n")))


def regrid_linear(samples: DataFrame, lengths: DataFrame, clock: DataFrame, slice_rows: int = 65_536, clock_name: str = "Time") -> DataFrame:
    """Every good channel on the time grid of its file, by linear interpolation.

    A channel of n points is taken as evenly spread over [t_min, t_max] of the
    file's clock; ends extrapolate.  Channels as long as the clock map point to
    point.  Result: (file, grp, channel, idx, time, value) and any further columns
    of ``clock``, which holds one row per file.

    The work is two equi-joins.  Grid points meet their file's channels on
    (file, slice of the index) -- channel facts are repeated per slice, so one
    huge file spreads over many tasks.  Each grid point then fetches the segment
    (y_i, y_i+1) of its channel on (channel, i), which is unique per key.
    """
    n = F.col("n")
    good = last_of_name(drop_bad_channels(lengths)).select(*CHANNEL, n)
    extra = [c for c in clock.columns if c not in (*CHANNEL, "n", "low", "high", "ordinal")]
    grid = (
        samples.where(F.col("channel") == clock_name)
        .join(clock.select(*CHANNEL), list(CHANNEL), "left_semi")
        .select("file", "idx", F.col("value").try_cast("double").alias("time"))
        .withColumn("slice", F.floor(F.col("idx") / slice_rows))
    )
    span = clock.select("file", F.col("n").alias("points"), F.col("low").alias("t0"), F.col("high").alias("t1"), *extra)
    facts = (
        good.join(span, "file")
        .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("points") - 1) / slice_rows))))
    )
    placed = grid.join(facts, ["file", "slice"])
    last = F.greatest(n - 2, F.lit(0))
    spread = F.nullif(F.col("t1") - F.col("t0"), F.lit(0.0))
    pos = (
        F.when(n == F.col("points"), F.col("idx").cast("double"))
        .when(n == 1, F.lit(0.0))
        .otherwise(F.coalesce((F.col("time") - F.col("t0")) / spread * (n - 1), F.lit(0.0)))
    )
    placed = placed.withColumn("pos", pos).withColumn(
        "i", F.least(F.greatest(F.floor("pos"), F.lit(0).cast("bigint")), last)
    )
    # Each sample is the left end of segment idx and the right end of segment idx-1.
    value = F.col("value").try_cast("double")
    ends = samples.select(
        *CHANNEL,
        F.explode(
            F.array(
                F.struct(F.col("idx").alias("i"), value.alias("left"), F.lit(None).cast("double").alias("right")),
                F.struct((F.col("idx") - 1).alias("i"), F.lit(None).cast("double").alias("left"), value.alias("right")),
            )
        ).alias("e"),
    )
    segments = ends.groupBy(*CHANNEL, F.col("e.i").alias("i")).agg(
        F.max("e.left").alias("y0"), F.max("e.right").alias("y1")
    )
    step = F.col("pos") - F.col("i")
    y = F.when(step == 0, F.col("y0")).otherwise(
        F.col("y0") + step * F.coalesce(F.col("y1") - F.col("y0"), F.lit(0.0))
    )
    return placed.join(segments, [*CHANNEL, "i"], "left").select(*CHANNEL, "idx", "time", y.alias("value"), *extra)


def start_of_file(meta: DataFrame) -> DataFrame:
    """(file, start): property, else date in the file name, else modification day."""
    return meta.groupBy("file").agg(
        F.min_by(F.col("props")["TestStart_Time"], F.when(F.col("props")["TestStart_Time"].isNotNull(), F.col("ordinal"))).alias("prop"),
        F.max("modified").alias("modified"),
    ).select("file", times.resolve_start(F.col("prop"), F.regexp_extract("file", "[^/]*$", 0), F.col("modified")).alias("start"))


def readings_from_channels(samples: DataFrame, meta: DataFrame, slice_rows: int = 65_536) -> DataFrame:
    """Whole channel ingest: choose the clock, drop bad channels, regrid, stamp."""
    lengths = with_ordinals(channel_lengths(samples), meta)
    clock = pick_time_channel(lengths)
    # The start instant joins the one-row-per-file clock, not the readings.
    grid = regrid_linear(samples, lengths, clock.join(start_of_file(meta), "file"), slice_rows)
    return grid.select(
        times.plus_seconds(F.col("start"), "time").alias("timestamp"), F.col("channel").alias("series_id"), "value", "file"
    )


def ts_from_offset(df: DataFrame, start: Column | str, seconds: str = "Time", out: str = "timestamp") -> DataFrame:
    start = F.lit(start).cast("timestamp_ntz") if isinstance(start, str) else start
    return df.withColumn(out, times.plus_seconds(start, seconds))


def synth_ts(samples: DataFrame, seconds: int = SECONDS_PER_SAMPLE, modified: str = "modified") -> DataFrame:
    """No clock in the file: modification time + 10 s per stored sample index."""
    return samples.withColumn(
        "timestamp", F.timestamp_add("SECOND", F.col("idx") * seconds, F.col(modified).cast("timestamp_ntz"))
    )


# --- timestamp resolution on headers -------------------------------------------
def resolve_ts_columns(df: DataFrame, start: Column | str | None = None) -> DataFrame:
    """Add ``timestamp`` from the best header present: Timestamp, timestamp,
    Date + Time, or Time as an offset from ``start``."""
    have = set(df.columns)
    if "Timestamp" in have:
        return df.withColumn("timestamp", times.any_timestamp("Timestamp"))
    if "timestamp" in have:
        return df.withColumn("timestamp", times.any_timestamp("timestamp"))
    if {"Date", "Time"} <= have:
        return df.withColumn("timestamp", times.any_timestamp(F.concat_ws(" ", F.col("Date"), F.col("Time"))))
    if "Time" in have and start is not None:
        return ts_from_offset(df, start)
    raise ValueError("no time column: need Timestamp, timestamp, Date + Time, or Time with a start")


def resolve_weather_ts(df: DataFrame) -> DataFrame:
    """Add ``timestamp`` to station records: date_time_local, unixtime, or the
    first column whose name mentions a date or time; no rows when there is none."""
    if "date_time_local" in df.columns:
        return df.withColumn("timestamp", times.station_timestamp("date_time_local"))
    if "unixtime" in df.columns:
        return df.withColumn("timestamp", times.from_unix("unixtime"))
    for c in df.columns:
        if "date" in c.lower() or "time" in c.lower():
            return df.withColumn("timestamp", times.any_timestamp(c))
    return df.withColumn("timestamp", F.lit(None).cast("timestamp_ntz")).where(F.lit(False))


def coerce_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Text to DOUBLE, unparsable and NaN to NULL; by default all but the time columns."""
    keep = {"timestamp", "date_time_local", "unixtime"}
    columns = [c for c in df.columns if c not in keep] if columns is None else columns
    return df.withColumns({c: to_double(F.col(f"`{c}`")) for c in columns})


def drop_null_ts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.na.drop(subset=[ts])


# --- series selection ------------------------------------------------------------
def identify_series(columns: list[str], known=TEMPERATURE_SENSORS, weather=()) -> tuple[list[str], list[str]]:
    """Column names holding a known sensor id; only when none match (of either
    kind), names that look like temperature."""
    temp = [c for c in columns if any(s in c for s in known)]
    met = [c for c in columns if any(s in c for s in weather)]
    if not temp and not met:
        temp = [c for c in columns if any(k in c.lower() for k in TEMPERATURE_KEYWORDS)]
    return temp, met


def identify_series_long(readings: DataFrame, known=TEMPERATURE_SENSORS, series: str = "series_id") -> DataFrame:
    """The same rule on a long table, per distinct series.  Whether any id matches
    is one scalar over the distinct names."""
    names = readings.select(series).distinct()
    exact = contains_any(F.col(series), known)
    any_exact = names.agg(F.coalesce(F.bool_or(exact), F.lit(False))).scalar()
    return names.where(F.when(any_exact, exact).otherwise(contains_any(F.lower(series), TEMPERATURE_KEYWORDS)))


def metric_select(df: DataFrame, metrics=WEATHER_METRICS) -> DataFrame:
    """``timestamp`` and those listed metrics the table has."""
    have = set(df.columns)
    return df.select("timestamp", *[m for m in metrics if m in have])


def to_long(wide: DataFrame, columns: list[str] | None = None, ids: tuple[str, ...] = ("timestamp",), name: str = "series_id") -> DataFrame:
    """Wide to (ids, series, value); missing values produce no row."""
    columns = [c for c in wide.columns if c not in ids] if columns is None else columns
    typed = wide.select(*ids, *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    return typed.unpivot(list(ids), columns, name, "value").where(F.col("value").isNotNull())


def enrich_sensor(readings: DataFrame, dim: DataFrame, decimals: int = 2, key: str = "series_id") -> DataFrame:
    """Attach depth and layer, round the value; unknown sensors are dropped.

    No broadcast hint: the dimension is broadcast when its measured size is below
    the session's threshold, otherwise it is joined by shuffle with skew splitting.
    """
    side = dim.select(F.col("sensor_id").alias(key), "depth", "layer")
    return readings.join(side, key).withColumn("value", F.round("value", decimals))


def profile(df: DataFrame, ts: str = "timestamp", columns: list[str] | None = None) -> DataFrame:
    """Time range, distinct instants and non-missing values per column, in one pass."""
    columns = [c for c in df.columns if c != ts] if columns is None else columns
    return df.agg(
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.count_distinct(F.col(ts)).alias("distinct_ts"),
        *[F.count(f"`{c}`").alias(f"n_{c}") for c in columns],
    )
