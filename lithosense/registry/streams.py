"""Streaming queries: each runs over everything available and returns its table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithosense.plans.incremental import update_level
from lithosense.registry.base import THRESHOLD, columns, query, rnd, sql
from lithosense.registry.rollups import DAY, SENSOR, TS, WEEK
from lithosense.session import scratch_path
from lithosense.sources import readers
from lithosense.streaming import late, rollups as S

_EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def _stream(t):
    raw = S.read_stream(t.spark, t.dir, _EVENTS, glob="events.parquet")
    return raw.select(F.col("ts").alias("timestamp"), F.concat(F.lit("S"), F.col("user_id") % 25).alias("series_id"), "value", "event_id")


_MAX = "(SELECT max(\"timestamp\") FROM readings)"


@query("stream_rollup_15min", sql(f"SELECT {columns(*TS)} FROM t15 WHERE \"timestamp\" + INTERVAL 15 MINUTE <= {_MAX} - INTERVAL 1 HOUR", "t15"))
def _(t):
    return rnd(S.run_to_table(S.stream_rollup_15min(_stream(t), "1 hour", THRESHOLD), "s15"))


@query("stream_rollup_closed", sql(f"SELECT {columns(*TS)} FROM t15", "t15"))
def _(t):
    """All 15-minute rows: what the stream emitted and the buckets still open when it ended."""
    emitted = S.run_to_table(S.stream_rollup_15min(_stream(t), "1 hour", THRESHOLD), "s15c")
    return rnd(S.close_15min(emitted, t.readings(), THRESHOLD))


@query("stream_two_runs", sql("SELECT series_id, count(*) AS n, count(DISTINCT event_id) AS ids FROM readings GROUP BY 1", "readings"))
def _(t):
    """Files that arrive after the first run are added by the second, and nothing twice."""
    root, path = scratch_path(t.spark, "arriving"), scratch_path(t.spark, "two-runs")
    events = t.events.select("ts", "user_id", "event_id", "value")
    for half in (0, 1):
        events.where(F.col("event_id") % 2 == half).write.mode("append").parquet(root)
        stream = S.read_stream(t.spark, root, "ts TIMESTAMP_NTZ, user_id BIGINT, event_id BIGINT, value DOUBLE")
        rows = S.run_to_table(stream.select(F.concat(F.lit("S"), F.col("user_id") % 25).alias("series_id"), "event_id"), "two-runs", path)
    return rows.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"))


@query("stream_cascade", sql(f"SELECT {columns(*TS)} FROM th WHERE \"timestamp\" + INTERVAL 1 HOUR <= {_MAX} - INTERVAL 1 HOUR", "th"))
def _(t):
    return rnd(S.run_to_table(S.stream_hourly(_stream(t), "1 hour", THRESHOLD), "sh"))


def _packed(t, folder: str | None = None):
    return t.packed(S.read_stream(t.spark, folder or t.dir, _EVENTS, glob=None if folder else "events.parquet", files_per_batch=1))


_PACKED_MAX = '(SELECT max("timestamp") FROM packed)'


@query("stream_daily", sql(f"SELECT {columns(*DAY)} FROM pd WHERE date + INTERVAL 1 DAY <= {_PACKED_MAX} - INTERVAL 1 HOUR", "pd"))
def _(t):
    return rnd(S.run_to_table(S.stream_daily(_packed(t), "1 hour", THRESHOLD), "sday"))


@query("stream_weekly", sql(f"SELECT {columns(*WEEK)} FROM pw WHERE week_start + INTERVAL 7 DAY <= {_PACKED_MAX} - INTERVAL 1 HOUR", "pw"))
def _(t):
    return rnd(S.run_to_table(S.stream_weekly(_packed(t), "1 hour", THRESHOLD), "sweek"))


@query("stream_weekly_two_runs", sql(f"SELECT {columns(*WEEK)} FROM pw WHERE week_start + INTERVAL 7 DAY <= {_PACKED_MAX} - INTERVAL 1 HOUR", "pw"))
def _(t):
    """The state of open days and weeks outlives the run that opened them."""
    folder, path = scratch_path(t.spark, "week-arrivals"), scratch_path(t.spark, "week-runs")
    for part in (F.col("ts") < "2024-01-14", F.col("ts") >= "2024-01-14"):
        t.events.where(part).coalesce(1).write.mode("append").parquet(folder)
        out = S.run_to_table(S.stream_weekly(_packed(t, folder), "1 hour", THRESHOLD), "sweek2", path)
    return rnd(out)


@query("stream_dedup", sql("SELECT series_id, count(*) AS n FROM readings GROUP BY 1", "readings"))
def _(t):
    """Every reading arrives twice and is kept once."""
    twice = _stream(t).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return S.run_to_table(S.stream_dedup(twice), "sd").groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))


@query("stream_upsert", sql("SELECT CAST(\"timestamp\" AS DATE) AS day, series_id, count(*) AS n, max(value) AS high FROM readings GROUP BY 1, 2", "readings"))
def _(t):
    path = scratch_path(t.spark, "stream-upsert")
    daily = S.watermarked(_stream(t), "1 day").groupBy(F.window("timestamp", "1 day").alias("w"), "series_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("high")
    ).select(F.col("w.start").cast("date").alias("day"), "series_id", "n", "high")
    S.run_upsert(daily, path, ["day", "series_id"], "day")
    return t.spark.read.parquet(path).select("day", "series_id", "n", "high")


@query("stream_late_rows", sql(f"SELECT {columns(*WEEK)} FROM pw", "pw"))
def _(t):
    """Files out of order: late rows wait in their table, are absorbed, and all levels equal one batch."""
    root, folder = scratch_path(t.spark, "stream-late"), scratch_path(t.spark, "arrivals")
    for part in (F.col("event_id") % 3 != 0, F.col("event_id") % 3 == 0):
        t.packed().where(part).coalesce(1).write.mode("append").parquet(folder)
        stream = S.read_stream(t.spark, folder, "timestamp TIMESTAMP_NTZ, series_id STRING, value DOUBLE", files_per_batch=1)
        late.run_merging(stream, root, SENSOR)
    late.absorb_late(t.spark, root, SENSOR)
    for level in ("15min", "hourly", "daily", "weekly"):
        update_level(t.spark, root, level, SENSOR)
    return rnd(readers.scan_rollup(t.spark, root, "weekly"))


@query("stream_late_table", sql("""SELECT count(*) AS n FROM packed WHERE event_id % 3 = 0
    AND time_bucket(INTERVAL 15 MINUTE, "timestamp", TIMESTAMP '2000-01-01') + INTERVAL 15 MINUTE <= (SELECT max("timestamp") - INTERVAL 1 HOUR FROM packed WHERE event_id % 3 <> 0)""", "packed"))
def _(t):
    """How many rows the late table holds: those of buckets that had closed before their file came."""
    root, folder = scratch_path(t.spark, "stream-late"), scratch_path(t.spark, "arrivals")
    for part in (F.col("event_id") % 3 != 0, F.col("event_id") % 3 == 0):
        t.packed().where(part).coalesce(1).write.mode("append").parquet(folder)
        late.run_merging(S.read_stream(t.spark, folder, "timestamp TIMESTAMP_NTZ, series_id STRING, value DOUBLE"), root, SENSOR)
    return late.late_rows(t.spark, root, "temperature").agg(F.count(F.lit(1)).alias("n"))


@query("late_policy", sql("SELECT CAST(\"timestamp\" AS DATE) AS date, series_id, count(*) AS n FROM readings WHERE abs(value) > 1.0 GROUP BY 1, 2", "readings"))
def _(t):
    """Days first stored without a third of their readings, then recomputed and replaced."""
    from lithosense.operators.rollup import rollup_15min
    from lithosense.sources.sinks import write_rollup

    root = scratch_path(t.spark, "late")
    early = t.readings().where(F.col("event_id") % 3 != 0)
    for part in (early, t.readings()):
        path = write_rollup(rollup_15min(part, threshold=THRESHOLD), root, "15min", "temperature", THRESHOLD)
    return t.spark.read.parquet(path).groupBy(F.col("day").alias("date"), "series_id").agg(F.sum("count").alias("n"))
