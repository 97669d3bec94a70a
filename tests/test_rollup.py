"""Hand-computed cases of the cascade."""

import datetime as dt
import math
import statistics

import pytest
from pyspark.sql import functions as F

from lithosense.operators import filters, gradients, rollup as R
from lithosense.operators.health import sensor_health
from lithosense.plans import cascade as C
from lithosense.schema import READING, ROLLUP

T = lambda text: dt.datetime.fromisoformat(text)
D = lambda text: dt.date.fromisoformat(text)


def readings(spark, rows):
    return spark.createDataFrame([(T(a), s, v) for a, s, v in rows], READING)


def test_single_reading_deviation_is_null_or_zero(spark):
    df = readings(spark, [("2024-01-01 00:01:00", "a", 5.0)])
    assert R.rollup_15min(df).first()["std"] is None
    assert R.rollup_15min_weather(df).first()["std"] == 0.0


def test_quarter_hour_statistics(spark):
    df = readings(spark, [("2024-01-01 00:14:59.999", "a", 1.0), ("2024-01-01 00:00:00", "a", 4.0), ("2024-01-01 00:15:00", "a", 9.0)])
    rows = {r["timestamp"]: r for r in R.rollup_15min(df).collect()}
    first = rows[T("2024-01-01 00:00:00")]
    assert (first["mean"], first["min"], first["max"], first["count"]) == (2.5, 1.0, 4.0, 2)
    assert first["std"] == pytest.approx(statistics.stdev([1.0, 4.0]))
    assert len(rows) == 2


def test_inactive_sensor_disappears_but_station_zero_stays(spark):
    df = readings(spark, [("2024-01-01 00:00:00", "a", 0.0), ("2024-01-01 00:01:00", "a", 0.001), ("2024-01-01 00:00:00", "b", -2.0), ("2024-01-01 00:00:05", "b", 0.0)])
    assert [(r["series_id"], r["count"]) for r in R.rollup_15min(df).collect()] == [("b", 1)]
    assert R.rollup_15min_weather(df).where("series_id = 'a'").first()["count"] == 2


def level(spark, name, rows):
    return spark.createDataFrame(rows, ROLLUP[name])


def fifteen(spark, rows):
    return level(spark, "15min", [(T(a), s, m, lo, hi, sd, n) for a, s, m, lo, hi, sd, n in rows])


def test_hour_pools_deviation_and_averages_means(spark):
    df = fifteen(spark, [("2024-01-01 10:00:00", "a", 10.0, 9.0, 11.0, 1.0, 10), ("2024-01-01 10:15:00", "a", 20.0, 15.0, 25.0, 2.0, 30)])
    h = R.rollup_hourly(df).first()
    centre = (10 * 10 + 20 * 30) / 40
    want = math.sqrt((10 * 1 + 30 * 4 + 10 * (10 - centre) ** 2 + 30 * (20 - centre) ** 2) / 40)
    assert h["mean"] == 15.0  # unweighted
    assert h["std"] == pytest.approx(want, abs=1e-12)
    assert (h["min"], h["max"], h["count"]) == (9.0, 25.0, 40)


def test_missing_deviation_poisons_or_counts_as_zero(spark):
    df = fifteen(spark, [("2024-01-01 10:00:00", "a", 10.0, 9.0, 11.0, 1.0, 10), ("2024-01-01 10:15:00", "a", 20.0, 20.0, 20.0, None, 1)])
    assert R.rollup_hourly(df).first()["std"] is None
    centre = (100 + 20) / 11
    want = math.sqrt((10 + 10 * (10 - centre) ** 2 + (20 - centre) ** 2) / 11)
    assert R.rollup_hourly(df, null_std="zero").first()["std"] == pytest.approx(want, abs=1e-12)


def test_two_pass_deviation_survives_large_offsets(spark):
    base = 1e8
    df = fifteen(spark, [("2024-01-01 10:00:00", "a", base, base, base, 0.5, 10), ("2024-01-01 10:15:00", "a", base + 1, base, base, 0.5, 10)])
    got = R.pooled_std_two_pass(df.withColumn("timestamp", F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")), ["timestamp", "series_id"]).first()["std"]
    assert got == pytest.approx(math.sqrt(0.25 + 0.25), abs=1e-9)


def test_exact_deviation_equals_raw(spark):
    values = [1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 7.0]
    df = readings(spark, [(f"2024-01-01 00:{5 * i:02d}:00", "a", v) for i, v in enumerate(values)])
    fine = R.rollup_15min(df).withColumn("hour", F.lit(0))
    assert R.exact_rollup(fine, ["hour"]).first()["std"] == pytest.approx(statistics.stdev(values))


def days(spark, rows):
    return level(spark, "daily", [(D(d), s, m, m - 1, m + 1, sd, 5, 2.0) for d, s, m, sd in rows])


def test_weeks_start_on_monday_and_cross_the_year(spark):
    df = days(spark, [("2023-12-31", "a", 1.0, 0.1), ("2024-01-01", "a", 2.0, 0.1), ("2024-12-31", "a", 3.0, 0.1), ("2025-01-01", "a", 4.0, 0.1)])
    got = {r["week_start"]: r["mean"] for r in R.rollup_weekly(df).collect()}
    assert got == {D("2023-12-25"): 1.0, D("2024-01-01"): 2.0, D("2024-12-30"): 3.5}


def test_week_end_rules(spark):
    df = days(spark, [("2024-01-01", "a", 1.0, 0.1), ("2024-01-03", "a", 2.0, 0.1)])
    assert R.rollup_weekly(df).first()["week_end"] == D("2024-01-03")
    assert R.rollup_weekly(df, week_end="calendar").first()["week_end"] == D("2024-01-07")


def test_sensor_week_drops_days_without_deviation(spark):
    df = days(spark, [("2024-01-01", "a", 1.0, None), ("2024-01-02", "a", 5.0, 0.1)])
    assert R.rollup_weekly(df).first()["mean"] == 5.0
    assert R.rollup_weekly(df, null_std="zero", week_end="calendar").first()["mean"] == 3.0


@pytest.mark.parametrize("rules", [C.TEMPERATURE, C.WEATHER])
def test_empty_input_gives_empty_levels(spark, rules):
    for df in C.cascade(readings(spark, []), rules).values():
        assert df.count() == 0


def test_cascade_equals_level_by_level(spark):
    rows = [((dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * i)).isoformat(), "ab"[i % 2], float(i % 37) + 1) for i in range(4000)]
    df = readings(spark, rows)
    rules = C.WEATHER
    levels, finer = C.cascade(df, rules), df
    total = len(rows)
    for name in ("15min", "hourly", "daily", "weekly"):
        finer = C.level_of(finer, name, rules)
        a = sorted(map(tuple, levels[name].select(*[F.round(c, 9) if t == "double" else F.col(c) for c, t in finer.dtypes]).collect()), key=str)
        b = sorted(map(tuple, finer.select(*[F.round(c, 9) if t == "double" else F.col(c) for c, t in finer.dtypes]).collect()), key=str)
        assert a == b
        assert levels[name].agg(F.sum("count")).first()[0] == total
        assert levels[name].where("mean < min OR mean > max OR std < 0").count() == 0


def test_partitioning_does_not_change_results(spark):
    df = readings(spark, [(f"2024-01-{1 + i % 20:02d} {i % 24:02d}:00:{i % 60:02d}", f"s{i % 3}", float(i)) for i in range(1, 2000)])
    one, many = (C.cascade(df.repartition(n), C.WEATHER)["weekly"].orderBy("week_start", "series_id").collect() for n in (1, 8))
    assert [(r["week_start"], r["series_id"], r["count"], round(r["std"], 9)) for r in one] == [(r["week_start"], r["series_id"], r["count"], round(r["std"], 9)) for r in many]


def test_wide_equals_long(spark):
    rows = [(T("2024-01-01") + dt.timedelta(minutes=i), float(i), None if i % 3 else float(-i), 0.0) for i in range(200)]
    wide = spark.createDataFrame(rows, "timestamp TIMESTAMP_NTZ, `TM a` DOUBLE, b DOUBLE, c DOUBLE")
    names = ["TM a", "b", "c"]
    long = wide.unpivot(["timestamp"], [F.col(f"`{n}`") for n in names], "series_id", "value")
    key = lambda df: sorted((r["timestamp"], r["series_id"], r["count"], round(r["mean"], 9)) for r in df.collect())
    assert key(R.rollup_15min_wide(wide, names)) == key(R.rollup_15min(long))


def test_boundary_hour_is_left_out(spark):
    df = fifteen(spark, [("2024-01-01 10:00:00", "a", 1.0, 1.0, 1.0, 0.1, 1), ("2024-01-01 11:00:00", "a", 2.0, 2.0, 2.0, 0.1, 1)])
    hours = R.rollup_hourly(df)
    got = [r["timestamp"] for r in filters.closed_buckets(hours, "hourly", "2024-01-01 11:20:00").collect()]
    assert got == [T("2024-01-01 10:00:00")]
    assert filters.closed_buckets(hours, "hourly", "2024-01-01 12:00:00").count() == 2


def test_last_complete_week(spark):
    week = lambda s: spark.range(1).select(filters.last_complete_week(s)).first()[0]
    assert week("2024-01-10") == D("2024-01-01")  # a Wednesday
    assert week("2024-01-14") == D("2024-01-01")  # a Sunday: its week is still running
    assert week("2024-01-15") == D("2024-01-08")


def test_gradient_and_health(spark):
    dim = spark.createDataFrame(
        [("a", "ASPHALT", 100.0, True), ("b", "BASE", 300.0, True), ("c", "BASE", 300.0, True)], "sensor_id STRING, layer STRING, depth DOUBLE, is_active BOOLEAN"
    )
    daily = days(spark, [("2024-01-01", "a", 20.0, 0.1), ("2024-01-01", "b", 10.0, 0.1)])
    g = gradients.layer_gradient(daily, dim, "date").first()
    assert g["asphalt_to_base"] == pytest.approx(10.0 / 0.2) and g["base_to_subbase"] is None
    q = fifteen(spark, [("2024-01-01 10:00:00", "a", 1.0, 1.0, 1.0, 0.5, 96), ("2024-01-01 10:00:00", "b", 1.0, 1.0, 1.0, 0.5, 40)])
    got = {r["series_id"]: r["health_status"] for r in sensor_health(q, dim, 96).collect()}
    assert got == {"a": "GOOD", "b": "CRITICAL", "c": "OFFLINE"}
