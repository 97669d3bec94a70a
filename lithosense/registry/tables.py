"""Sources and sinks, exercised by writing derived tables to scratch and reading them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithosense.operators import ingest as I
from lithosense.plans import cascade as C
from lithosense.plans.incremental import update_level
from lithosense.registry.base import columns, query, r, rnd, sql
from lithosense.registry.rollups import DAY, SENSOR, TS, WEEK, t15, z
from lithosense.schema import SECTION_TABLES
from lithosense.session import materialise, scratch_path
from lithosense.sources import clustered, readers, sinks, state, warehouse


def _csv(df, path):
    df.write.option("header", True).csv(path)
    return path


def _station(t, shift=0.0, keep=None):
    """Station records as the CSV files hold them: quoted clock text with a zone suffix."""
    src = t.events if keep is None else t.events.where(keep)
    return src.select(
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.when(F.col("event_id") % 2 == 0, " EDT").otherwise(" EST")).alias("date_time_local"),
        F.when(F.col("event_id") % 6 == 0, F.lit("n/a")).otherwise((F.col("value") + shift).cast("string")).alias("temperature"),
        F.col("user_id").cast("string").alias("relative_humidity"),
    )


_ROW = "date_trunc('second', ts) AS \"timestamp\", CASE WHEN event_id % 6 <> 0 THEN value END AS temperature, user_id::DOUBLE AS relative_humidity"


@query("scan_weather", sql(f"SELECT {_ROW} FROM events"))
def _(t):
    path = _csv(_station(t), scratch_path(t.spark, "station"))
    return readers.scan_weather(t.spark, path).select("timestamp", "temperature", "relative_humidity")


@query("scan_weather_dir", sql(f"SELECT {_ROW} FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY date_trunc('second', ts) ORDER BY event_id) = 1)"))
def _(t):
    """Two overlapping exports, the second with its columns in another order and one more; the first file wins per instant."""
    root = scratch_path(t.spark, "stations")
    _csv(_station(t), f"{root}/a")
    _csv(_station(t, 1000.0, F.col("event_id") % 4 == 0).select("relative_humidity", F.lit("x").alias("station"), "temperature", "date_time_local"), f"{root}/b")
    return readers.scan_weather_dir(t.spark, f"{root}/*").select("timestamp", "temperature", "relative_humidity")


@query("scan_readings_wide", sql("SELECT date_trunc('second', ts) AS \"timestamp\", event_type AS series_id, value FROM events"))
def _(t):
    kinds = ("view", "click", "error", "purchase", "signup")
    wide = t.events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("Date"), F.date_format("ts", "HH:mm:ss").alias("Time"),
        *[F.when(F.col("event_type") == k, F.col("value")).alias(k) for k in kinds],
    )
    df = readers.scan_readings_wide(t.spark, _csv(wide, scratch_path(t.spark, "wide")))
    return I.to_long(I.coerce_numeric(df, list(kinds)), list(kinds))


@query("scan_channels", sql("SELECT event_type AS channel, count(*) AS n, sum(idx)::BIGINT AS idx_sum, round(sum(value) + 1.7e-5, 2) AS total FROM (SELECT *, row_number() OVER (PARTITION BY user_id % 2, event_type ORDER BY ts, event_id) - 1 AS idx FROM events) GROUP BY 1"))
def _(t):
    from lithosense.registry.ingest import channel_samples

    root = scratch_path(t.spark, "channels")
    s = channel_samples(t)
    s.write.parquet(f"{root}/samples")
    s.groupBy("file", "grp", "channel").agg(F.count(F.lit(1)).alias("n")).select(
        "file", "grp", "channel", F.lit(0).alias("ordinal"), "n", F.create_map().cast("map<string,string>").alias("props"), F.lit(None).cast("timestamp").alias("modified")
    ).write.parquet(f"{root}/meta")
    samples, meta = readers.scan_channels(t.spark, f"{root}/samples", f"{root}/meta")
    good = I.drop_bad_channels(I.channel_lengths(samples)).select("file", "grp", "channel")
    facts = meta.where(F.col("modified").isNotNull()).select("file", "grp", "channel")
    return (
        samples.join(facts, ["file", "grp", "channel"], "left_semi").join(good, ["file", "grp", "channel"], "left_semi").groupBy("channel")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("idx").alias("idx_sum"), F.round(F.sum(F.col("value").cast("double")) + 1.7e-5, 2).alias("total"))
    )


@query("scan_section_tables", sql(" UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n, count(DISTINCT SHRP_ID) AS sections FROM {n}" for n in SECTION_TABLES), *SECTION_TABLES))
def _(t):
    root = scratch_path(t.spark, "annual")
    for name, df in t.section_tables().items():
        _csv(df, f"{root}/{name}")
    found = readers.scan_section_tables(t.spark, root)
    out = None
    for name, df in found.items():
        part = df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.count_distinct("SHRP_ID").alias("sections"))
        out = part if out is None else out.unionByName(part)
    return out


_VALID = "abs(mean) > 1.0 OR abs(min) > 1.0 OR abs(max) > 1.0"


@query("write_rollup", sql(f"SELECT {columns(*DAY)} FROM td", "td"))
def _(t):
    """Storing the same days twice gives the table once."""
    from lithosense.registry.rollups import td

    root = scratch_path(t.spark, "levels")
    for _ in range(2):
        sinks.write_rollup(td(t), root, "daily", "temperature", 1.0)
    stored = t.spark.read.parquet(f"{root}/kind=temperature/level=daily")
    return rnd(stored.drop("day"))


@query("scan_rollup", sql(f"SELECT {columns(*TS)} FROM t15 WHERE {_VALID}", "t15"))
def _(t):
    root = scratch_path(t.spark, "levels")
    sinks.write_rollup(t15(t), root, "15min", "temperature", 1.0)
    return rnd(readers.scan_rollup(t.spark, root, "15min"))


@query("scan_rollup_csv", sql(f"SELECT {columns(*DAY)} FROM zd", "zd"))
def _(t):
    """Two appended copies of the statistics files; the first row per key stays."""
    root = scratch_path(t.spark, "csv-levels")
    daily = z(t)["daily"].withColumnRenamed("series_id", "sensor_id")
    for part in ("temperature_daily_20240201.csv", "temperature_daily_20240202.csv"):
        _csv(daily, f"{root}/{part}")
    return rnd(readers.scan_rollup_csv(t.spark, root, "daily"))


@query("stored_cascade", sql(f"SELECT {columns(*WEEK)} FROM pw", "pw"))
def _(t):
    """Every level from the stored finer one, as the scheduled jobs run it."""
    root = scratch_path(t.spark, "cascade")
    finer = t.packed()
    for level in ("15min", "hourly", "daily"):
        sinks.write_rollup(C.level_of(finer, level, SENSOR), root, level, "temperature", 1.0)
        finer = readers.scan_rollup(t.spark, root, level)
    return rnd(C.level_of(finer, "weekly", SENSOR))


_STEPS = ("15min", "hourly", "daily", "weekly")


def _deliveries(t):
    """All readings in two: the second holds late ones, some of them days old, that share buckets with the first."""
    noon = F.lit("2024-01-04 12:00:00").cast("timestamp_ntz")
    early = (F.col("timestamp") < noon) & ((F.col("timestamp") < "2024-01-04") | (F.col("event_id") % 3 != 0))
    early = early & ((F.col("timestamp") >= "2024-01-02") | (F.col("event_id") % 7 != 0))
    return t.packed().where(early), t.packed().where(~early)


@query("incremental_run", sql(f"SELECT {columns(*WEEK)} FROM pw", "pw"))
def _(t):
    """A first delivery, one of nothing but the late readings, and that one again: the runs store what one would."""
    root = scratch_path(t.spark, "incremental")
    first, late = _deliveries(t)
    for readings in (first, late, late):
        for level in _STEPS:
            update_level(t.spark, root, level, SENSOR, readings)
    return rnd(readers.scan_rollup(t.spark, root, "weekly"))


@query("incremental_15min", sql(f"SELECT {columns(*TS)} FROM p15 WHERE {_VALID}", "p15"))
def _(t):
    """Buckets merged from parts of two deliveries, the second stored first."""
    root = scratch_path(t.spark, "incremental-15min")
    for readings in reversed(_deliveries(t)):
        update_level(t.spark, root, "15min", SENSOR, readings)
    return rnd(readers.scan_rollup(t.spark, root, "15min"))


@query("incremental_overlap", sql(f"SELECT {columns(*WEEK)} FROM pw", "pw"))
def _(t):
    """Exports that overlap: the second delivery repeats all readings of the first."""
    root = scratch_path(t.spark, "incremental-overlap")
    for readings in (_deliveries(t)[0], t.packed(), t.packed()):
        for level in _STEPS:
            update_level(t.spark, root, level, SENSOR, readings, overlap=True)
    return rnd(readers.scan_rollup(t.spark, root, "weekly"))


@query("append_new_only", sql("SELECT week_start, series_id, count, 'old' AS origin FROM zw WHERE week_start < DATE '2024-01-15' UNION ALL SELECT week_start, series_id, count, 'new' FROM zw WHERE week_start >= DATE '2024-01-15'", "zw"))
def _(t):
    path = scratch_path(t.spark, "append")
    weekly = z(t)["weekly"].select("week_start", "series_id", "count")
    sinks.append_new_only(weekly.where(F.col("week_start") < "2024-01-15").withColumn("origin", F.lit("old")), path, ["week_start", "series_id"])
    sinks.append_new_only(weekly.withColumn("origin", F.lit("new")), path, ["week_start", "series_id"])
    return t.spark.read.parquet(path)


@query("upsert", sql("SELECT week_start, series_id, count, CASE WHEN series_id IN ('S1', 'S2') AND week_start >= DATE '2024-01-15' THEN 'new' ELSE 'old' END AS origin FROM zw", "zw"))
def _(t):
    path = scratch_path(t.spark, "upsert")
    weekly = z(t)["weekly"].select("week_start", "series_id", "count")
    sinks.upsert(weekly.withColumn("origin", F.lit("old")), path, ["week_start", "series_id"], "week_start")
    fresh = weekly.where((F.col("week_start") >= "2024-01-15") & F.col("series_id").isin("S1", "S2"))
    sinks.upsert(fresh.withColumn("origin", F.lit("new")), path, ["week_start", "series_id"], "week_start")
    return t.spark.read.parquet(path).select("week_start", "series_id", "count", "origin")


_OPEN_DAY = "CASE WHEN count % 3 = 0 THEN NULL ELSE week_start END AS week_start, series_id || ':' || week_start AS series_id"


@query("upsert_null_partition", sql(f"SELECT {_OPEN_DAY}, count, CASE WHEN series_id IN ('S1', 'S2') THEN 'new' ELSE 'old' END AS origin FROM zw", "zw"))
def _(t):
    """Rows without a partition value stay, and are replaced by key like others."""
    path = scratch_path(t.spark, "upsert-null")
    weekly = z(t)["weekly"].select(
        F.when(F.col("count") % 3 != 0, F.col("week_start")).alias("week_start"), F.concat_ws(":", "series_id", "week_start").alias("series_id"), "count", F.col("series_id").alias("sensor"))
    old = weekly.withColumn("origin", F.lit("old"))
    new = weekly.where(F.col("sensor").isin("S1", "S2")).withColumn("origin", F.lit("new"))
    for rows in (old, new):
        sinks.upsert(rows.drop("sensor"), path, ["week_start", "series_id"], "week_start")
    return t.spark.read.parquet(path).select("week_start", "series_id", "count", "origin")


@query("upsert_duplicate_keys", sql("SELECT week_start, series_id, 2 AS version FROM zw", "zw"))
def _(t):
    """Of new rows with one key the last by order counts."""
    path = scratch_path(t.spark, "upsert-twice")
    weekly = z(t)["weekly"].select("week_start", "series_id", F.explode(F.array(F.lit(2), F.lit(0), F.lit(1))).alias("version"))
    sinks.upsert(weekly, path, ["week_start", "series_id"], "week_start", order=["version"])
    return t.spark.read.parquet(path).select("week_start", "series_id", "version")


@query("append_duplicate_keys", sql("SELECT week_start, series_id, 0 AS version FROM zw", "zw"))
def _(t):
    """Of new rows with one key the first by order is appended, and a second run appends nothing."""
    path = scratch_path(t.spark, "append-twice")
    weekly = z(t)["weekly"].select("week_start", "series_id", F.explode(F.array(F.lit(2), F.lit(0), F.lit(1))).alias("version"))
    for _ in range(2):
        sinks.append_new_only(weekly, path, ["week_start", "series_id"], order=["version"])
    return t.spark.read.parquet(path)


@query("archive_manifest", sql("""SELECT DATE '2024-01-08' AS interval_start, DATE '2024-01-14' AS interval_end, count(*) AS rows, 'COMPLETED' AS status FROM zd WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'""", "zd"))
def _(t):
    """The stored manifest after two runs, and an empty one for a week without rows."""
    root, archive = scratch_path(t.spark, "current"), scratch_path(t.spark, "archive")
    sinks.write_rollup(z(t)["daily"], root, "daily", "weather")
    for _ in range(2):
        manifest = sinks.archive_week(t.spark, root, archive, "daily", "weather", "2024-01-08")
    nothing = sinks.archive_week(t.spark, root, archive, "daily", "weather", "2001-01-01")
    return manifest.unionByName(nothing).select("interval_start", "interval_end", "rows", "status")


@query("seed_dimension", sql("SELECT sensor_id, CASE WHEN depth < 300 THEN -1.0::DOUBLE ELSE depth END AS depth FROM dim", "dim"))
def _(t):
    path = scratch_path(t.spark, "dim")
    dim = t.dim().select("sensor_id", "depth")
    sinks.seed_dimension(dim.where("depth < 300").withColumn("depth", F.lit(-1.0)), path)
    sinks.seed_dimension(dim, path)
    return t.spark.read.parquet(path)


@query("export_tables", sql(f"SELECT {columns(*WEEK)} FROM zw", "zw"))
def _(t):
    path = sinks.export_table(z(t)["weekly"], scratch_path(t.spark, "export"))
    return rnd(t.spark.read.parquet(path))


@query("archive_week", sql("SELECT 'archived' AS part, count(*) AS rows FROM zd WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' UNION ALL SELECT 'current', count(*) FROM zd WHERE date NOT BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'", "zd"))
def _(t):
    root = scratch_path(t.spark, "current")
    path = sinks.write_rollup(z(t)["daily"], root, "daily", "weather")
    manifest = sinks.archive_week(t.spark, root, scratch_path(t.spark, "archive"), "daily", "weather", "2024-01-08")
    left = t.spark.read.parquet(path).agg(F.lit("current").alias("part"), F.count(F.lit(1)).alias("rows"))
    return manifest.select(F.lit("archived").alias("part"), "rows").unionByName(left)


@query("processing_state", sql("""SELECT event_type AS status_type, CASE WHEN event_type = 'view' THEN TIMESTAMP '2030-01-01' ELSE max(ts) END AS last_processed FROM events GROUP BY 1
    UNION ALL SELECT 'never ran', TIMESTAMP '2000-01-01'"""))
def _(t):
    path = scratch_path(t.spark, "state")
    marks = state.processing_marks(t.events, "event_type", "ts")
    full = marks.select("status_type", F.col("last_processed").alias("last_run"), "last_processed", F.lit("SUCCESS").alias("status"), F.lit("").alias("message"))
    state.update_state(t.spark, path, full)
    later = full.where(F.col("status_type") == "view").withColumn("last_processed", F.lit("2030-01-01").cast("timestamp_ntz"))
    state.update_state(t.spark, path, later)
    kept = state.read_state(t.spark, path)
    never = kept.agg(F.lit("never ran").alias("status_type")).withColumn("last_processed", state.last_mark(kept, "never ran"))
    return kept.select("status_type", "last_processed").unionByName(never)


@query("create_schema", sql("""SELECT SensorID, MeanValue::DOUBLE AS MeanValue, ReadingCount, IntervalEnd FROM (SELECT series_id AS SensorID, round(mean + 1.7e-9, 2) AS MeanValue,
    count::INT AS ReadingCount, "timestamp" + INTERVAL 1 HOUR AS IntervalEnd FROM zh)""", "zh"))
def _(t):
    """Create the warehouse, load the hourly level into its table, read it back."""
    import uuid

    db = f"w_{uuid.uuid4().hex[:12]}"
    root = scratch_path(t.spark, "warehouse")
    warehouse.create_schema(t.spark, db, root)
    hourly = z(t)["hourly"].withColumns({c: F.col(c) + 1.7e-9 for c in ("mean", "min", "max", "std")})
    rows = warehouse.to_warehouse_rollup(hourly, "hourly", "2024-02-01 00:00:00")
    target = t.spark.table(f"{db}.TempDataHourly")
    rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns]).write.insertInto(f"{db}.TempDataHourly", overwrite=True)
    out = t.spark.read.schema(target.schema).parquet(f"{root}/TempDataHourly")
    t.spark.sql(f"DROP DATABASE {db} CASCADE")  # tables are external: files stay
    return out.select("SensorID", F.col("MeanValue").cast("double").alias("MeanValue"), "ReadingCount", "IntervalEnd")


@query("clustered_reports", sql("""SELECT x.event_id, x.series_id, layer, """ + r("value - lag(value) OVER (PARTITION BY x.series_id ORDER BY \"timestamp\", x.event_id)", "change") + """,
    max("timestamp") OVER (PARTITION BY x.series_id) AS latest FROM readings x JOIN dim ON sensor_id = series_id""", "readings", "dim"))
def _(t):
    """Change, latest instant and layer of every reading, from two tables clustered by sensor."""
    import uuid

    from pyspark.sql import Window

    name = f"c_{uuid.uuid4().hex[:12]}"
    root = scratch_path(t.spark, "clustered")
    reads = clustered.write_clustered(t.readings(), f"{name}_readings", 4, order=("timestamp", "event_id"), path=f"{root}/readings")
    dim = clustered.write_clustered(t.dim().withColumnRenamed("sensor_id", "series_id"), f"{name}_dim", 4, order=(), path=f"{root}/dim")
    series = Window.partitionBy("series_id")
    out = reads.join(dim.select("series_id", "layer"), "series_id").select(
        "event_id", "series_id", "layer", (F.col("value") - F.lag("value").over(series.orderBy("timestamp", "event_id"))).alias("change"), F.max("timestamp").over(series).alias("latest")
    )
    out = materialise(out, "clustered")
    for part in ("readings", "dim"):
        clustered.drop_table(reads, f"{name}_{part}")  # external: the catalog entry goes
    return rnd(out)
