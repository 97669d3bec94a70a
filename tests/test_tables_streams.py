import datetime as dt

from pyspark.sql import functions as F

from lithosense import jobs
from lithosense.operators import rollup as R
from lithosense.plans import cascade as C
from lithosense.plans.incremental import update_level
from lithosense.registry.base import Tables
from lithosense.sources import readers, sinks, state, warehouse
from lithosense.streaming import rollups as S

D = dt.date.fromisoformat


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_rerun_of_a_day_replaces_only_that_day(spark, tmp_path):
    ddl = "date DATE, series_id STRING, mean DOUBLE, min DOUBLE, max DOUBLE, std DOUBLE, count BIGINT, temp_range DOUBLE"
    day = lambda d, m: (D(d), "a", m, m, m, 0.0, 1, 0.0)
    root = str(tmp_path)
    sinks.write_rollup(spark.createDataFrame([day("2024-01-01", 1.0), day("2024-01-02", 2.0)], ddl), root, "daily")
    path = sinks.write_rollup(spark.createDataFrame([day("2024-01-02", 5.0), day("2024-01-02", 0.0)], ddl), root, "daily")
    assert [(r["date"], r["mean"]) for r in spark.read.parquet(path).orderBy("date").collect()] == [(D("2024-01-01"), 1.0), (D("2024-01-02"), 5.0)]


def test_upsert_new_wins_and_append_old_wins(spark, tmp_path):
    ddl = "week_start DATE, series_id STRING, v INT"
    old = spark.createDataFrame([(D("2024-01-01"), "a", 1), (D("2024-01-08"), "a", 2)], ddl)
    new = spark.createDataFrame([(D("2024-01-08"), "a", 20), (D("2024-01-08"), "b", 30)], ddl)
    key = ["week_start", "series_id"]
    up, app = str(tmp_path / "u"), str(tmp_path / "a")
    sinks.upsert(old, up, key, "week_start")
    sinks.upsert(new, up, key, "week_start")
    sinks.upsert(new, up, key, "week_start")
    assert rows(spark.read.parquet(up).select("week_start", "series_id", "v")) == [(D("2024-01-01"), "a", 1), (D("2024-01-08"), "a", 20), (D("2024-01-08"), "b", 30)]
    sinks.append_new_only(old, app, key)
    assert rows(sinks.append_new_only(new, app, key)) == [(D("2024-01-08"), "b", 30)]
    assert sinks.append_new_only(new, app, key).count() == 0
    assert rows(spark.read.parquet(app)) == [(D("2024-01-01"), "a", 1), (D("2024-01-08"), "a", 2), (D("2024-01-08"), "b", 30)]


def test_archive_rule_and_rerun(spark, tmp_path):
    assert sinks.archive_due(None, "2024-01-01") and sinks.archive_due("2024-01-01", "2024-01-08")
    assert not sinks.archive_due("2024-01-01 10:00:00", "2024-01-08 09:00:00")
    ddl = "date DATE, series_id STRING, mean DOUBLE, min DOUBLE, max DOUBLE, std DOUBLE, count BIGINT, temp_range DOUBLE"
    df = spark.createDataFrame([(D("2024-01-01") + dt.timedelta(days=i), "a", 1.0, 1.0, 1.0, 0.0, 1, 0.0) for i in range(14)], ddl)
    path = sinks.write_rollup(df, str(tmp_path / "cur"), "daily")
    for _ in range(2):
        m = sinks.archive_week(spark, str(tmp_path / "cur"), str(tmp_path / "arc"), "daily", "temperature", "2024-01-01").first()
        assert (m["rows"], m["status"], m["interval_end"]) == (7, "COMPLETED", D("2024-01-07")) and m["file_size"] > 0
        assert spark.read.parquet(path).agg(F.min("date")).first()[0] == D("2024-01-08")


def test_state_default_and_update(spark, tmp_path):
    path = str(tmp_path / "state")
    mark = lambda: spark.range(1).select(state.last_mark(state.read_state(spark, path), "hourly")).first()[0]
    assert mark() == dt.datetime(2000, 1, 1)
    row = lambda ts: spark.createDataFrame([("hourly", None, ts, "SUCCESS", "")], "status_type STRING, last_run TIMESTAMP_NTZ, last_processed TIMESTAMP_NTZ, status STRING, message STRING")
    state.update_state(spark, path, row(dt.datetime(2024, 1, 1)))
    state.update_state(spark, path, row(dt.datetime(2024, 1, 2)))
    assert mark() == dt.datetime(2024, 1, 2) and state.read_state(spark, path).count() == 1


def test_known_sensors_and_schema(spark):
    dim = warehouse.sensor_dimension(spark)
    assert dim.count() == 13
    assert {r["layer"]: r["n"] for r in dim.groupBy("layer").agg(F.count("*").alias("n")).collect()} == {"ASPHALT": 6, "BASE": 2, "SUBBASE": 3, "SUBGRADE": 2}
    tables = warehouse.table_columns()
    assert len(tables) == 20  # nineteen warehouse tables and the sensor metadata
    names = warehouse.create_schema(spark, "schema_test")
    try:
        found = {r["tableName"].lower() for r in spark.sql("SHOW TABLES IN schema_test").where("NOT isTemporary").collect()}
        assert {n.lower() for n in names} == found
    finally:
        spark.sql("DROP DATABASE schema_test CASCADE")


def test_stream_equals_batch_on_closed_buckets(spark, sf):
    t = Tables(spark, sf)
    ddl = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    src = S.read_stream(spark, sf, ddl, glob="events.parquet").select(F.col("ts").alias("timestamp"), F.col("event_type").alias("series_id"), "value")
    got = S.run_to_table(S.stream_rollup_15min(src, "30 minutes"), "t")
    last = t.events.agg(F.max("ts")).first()[0]
    batch = R.rollup_15min(t.dense()).where(F.timestamp_add("MINUTE", F.lit(45), F.col("timestamp")) <= F.lit(last).cast("timestamp_ntz"))
    key = lambda df: sorted((r["timestamp"], r["series_id"], r["count"], round(r["mean"], 9), r["std"] and round(r["std"], 9)) for r in df.collect())
    assert key(got) == key(batch) and got.count() > 0


def test_jobs_run_all_levels(spark, tmp_path):
    text = ["date_time_local,temperature,relative_humidity"]
    for i in range(600):
        ts = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=30 * i)
        text.append(f"{ts} EST,{i % 30},{50 + i % 7}")
    src = tmp_path / "in"
    src.mkdir()
    (src / "w1.csv").write_text("\n".join(text))
    out = str(tmp_path / "out")
    for _ in range(2):  # repeating a run changes nothing
        jobs.main(["rollup", "--kind", "weather", "--in", str(src), "--out", out, "--as-of", "2024-01-13 00:00:00"])
        counts = {lv: readers.scan_rollup(spark, out, lv, "weather").agg(F.sum("count")).first()[0] for lv in ("15min", "hourly", "daily", "weekly")}
        assert counts == {"15min": 1152, "hourly": 1152, "daily": 1152, "weekly": 672}
    marks = {r["status_type"]: r["last_processed"] for r in state.read_state(spark, f"{out}/_state").collect()}
    assert marks["weather_daily"] == dt.datetime(2024, 1, 12) and marks["weather_weekly"] == dt.datetime(2024, 1, 1)


def test_late_deliveries_of_any_age_reach_all_levels(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(minutes=10 * i), s, float(5 + i % 11)) for i in range(6 * 24 * 20) for s in ("S0", "S1")]
    is_late = lambda ts, s: s == "S1" and ts.day in (2, 3, 9)
    late, early = [r for r in rows if is_late(*r[:2])], [r for r in rows if not is_late(*r[:2])]
    table = lambda part: spark.createDataFrame(part, "timestamp timestamp_ntz, series_id string, value double")
    levels = ("15min", "hourly", "daily", "weekly")
    twice, once = str(tmp_path / "twice"), str(tmp_path / "once")
    # the second delivery holds nothing but the late series; each level is a run of its own
    for part in (early, late):
        for level in levels:
            update_level(spark, twice, level, C.TEMPERATURE, table(part))
    for level in levels:
        update_level(spark, once, level, C.TEMPERATURE, table(rows))
    for level in levels:
        key = lambda root: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in readers.scan_rollup(spark, root, level).drop("day").collect())
        assert key(twice) == key(once), level
    marks = [{r["status_type"]: r["last_processed"] for r in state.read_state(spark, f"{root}/_state").collect()} for root in (twice, once)]
    assert marks[0] == marks[1]
    assert update_level(spark, twice, "15min", C.TEMPERATURE, table(late)).count() == 0
