"""Deliveries that add to stored buckets, and late rows of a stream."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from lithosense.operators import rollup as R
from lithosense.plans import cascade as C, parts as P
from lithosense.plans.incremental import deliver, update_level
from lithosense.sources import readers
from lithosense.streaming import late, rollups as S

DDL = "timestamp TIMESTAMP_NTZ, series_id STRING, value DOUBLE"
LEVELS = ("15min", "hourly", "daily", "weekly")
START = dt.datetime(2024, 1, 1)


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def table(spark, rows):
    return spark.createDataFrame(rows, DDL)


def stored(spark, root, level="15min", kind="temperature"):
    rows = readers.scan_rollup(spark, root, level, kind).collect()
    return sorted(tuple(round(v, 7) if isinstance(v, float) else v for v in r) for r in rows)


def run(spark, root, rows, levels=LEVELS, rules=C.TEMPERATURE, **options):
    df = rows if hasattr(rows, "columns") else table(spark, rows)
    for level in levels:
        update_level(spark, root, level, rules, df, **options)


def test_a_late_reading_adds_to_its_bucket(spark, tmp_path):
    first = [(at(i), "S0", 10.0 + i) for i in range(10)] + [(at(600), "S0", 5.0)]
    last = [(at(12), "S0", 99.0)]
    twice, once = str(tmp_path / "twice"), str(tmp_path / "once")
    run(spark, twice, first, ["15min"])
    for _ in range(2):  # the second time changes nothing
        run(spark, twice, last, ["15min"])
    run(spark, once, first + last, ["15min"])
    assert stored(spark, twice) == stored(spark, once)
    bucket = readers.scan_rollup(spark, twice, "15min").where(F.col("timestamp") == START).first()
    assert bucket["count"] == 11 and bucket["max"] == 99.0 and bucket["mean"] == pytest.approx(sum(v for *_, v in first[:10] + last) / 11)


def test_many_deliveries_equal_one_batch_on_all_levels(spark, tmp_path):
    rules = C.WEATHER
    rows = [(at(7 * i), s, 1e6 + math.sin(i) + k) for i in range(1500) for k, s in enumerate(("S0", "S1"))]
    split, whole = str(tmp_path / "split"), str(tmp_path / "whole")
    for part in range(2):
        run(spark, split, [r for i, r in enumerate(rows) if (i * 7) % 3 % 2 == part], rules=rules)
    run(spark, whole, rows, rules=rules)
    for level in LEVELS:
        a, b = (readers.scan_rollup(spark, root, level, rules.kind).orderBy(*readers.scan_rollup(spark, root, level, rules.kind).columns[:1], "series_id").collect() for root in (split, whole))
        assert len(a) == len(b) > 0
        for x, y in zip(a, b):
            for c in ("mean", "min", "max", "std"):
                assert (x[c] is None and y[c] is None) or x[c] == pytest.approx(y[c], rel=1e-6, abs=1e-7), (level, c)
            assert x["count"] == y["count"]


def test_deliveries_are_told_apart_by_file(spark, tmp_path):
    rows = table(spark, [(at(i), "S0", float(i + 1)) for i in range(6)])
    files = rows.withColumn("delivery", F.when(F.col("value") < 4, "a.csv").otherwise("b.csv"))
    root = str(tmp_path)
    run(spark, root, files.where("delivery = 'a.csv'"), ["15min"])
    run(spark, root, files, ["15min"])  # the folder again, with one file more
    assert readers.scan_rollup(spark, root, "15min").first()["count"] == 6
    mended = files.withColumn("value", F.when(F.col("value") == 1, 7.0).otherwise(F.col("value")))
    run(spark, root, mended, ["15min"])  # a file whose content changed replaces its own part
    assert stored(spark, root)[0][3:6:2] == (2.0, pytest.approx(math.sqrt(sum((v - 27 / 6) ** 2 for v in (7, 2, 3, 4, 5, 6)) / 5), abs=1e-6))


def test_overlapping_deliveries(spark, tmp_path):
    rows = [(at(i), s, float(i + 1)) for i in range(90) for s in ("S0", None)]
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    for part in (rows[:100], rows[40:], rows):
        run(spark, a, part, ["15min"], overlap=True)
    run(spark, b, rows, ["15min"])
    key = lambda root: sorted((str(r["timestamp"]), str(r["series_id"]), r["count"], r["max"]) for r in readers.scan_rollup(spark, root, "15min").collect())
    assert key(a) == key(b)


def test_a_level_stored_without_parts_is_kept(spark, tmp_path):
    from lithosense.sources import sinks

    root = str(tmp_path)
    early = [(at(i), "S0", 10.0 + i) for i in range(10)]
    sinks.write_rollup(R.rollup_15min(table(spark, early)), root, "15min")
    run(spark, root, [(at(11), "S0", 40.0)], ["15min"])
    want = R.rollup_15min(table(spark, early + [(at(11), "S0", 40.0)])).first()
    got = readers.scan_rollup(spark, root, "15min").first()
    assert got["count"] == 11 and got["std"] == pytest.approx(want["std"]) and got["mean"] == pytest.approx(want["mean"])


def test_open_buckets_wait_for_a_later_run(spark, tmp_path):
    root = str(tmp_path)
    rows = [(at(i), "S0", 10.0 + i) for i in range(40)]
    run(spark, root, rows, ["15min"], as_of=str(at(30)))
    assert len(stored(spark, root)) == 2
    update_level(spark, root, "15min", C.TEMPERATURE, None, as_of=str(at(60)))
    assert len(stored(spark, root)) == 3
    run(spark, root, [(at(50), "S0", 1.0)], ["15min"], full=True)
    assert len(stored(spark, root)) == 1  # a full run replaces its days


def test_parts_merge_in_any_number(spark):
    rows = [(at(i % 30), "S0", 1e9 + (i * 37 % 11) / 10) for i in range(400)]
    df = table(spark, rows).withColumn("delivery", (F.col("value") * 10 % 7).cast("int").cast("string"))
    got = {r["timestamp"]: r for r in P.merged(P.parts_of(df, C.TEMPERATURE), C.TEMPERATURE).collect()}
    for r in R.rollup_15min(table(spark, rows)).collect():
        g = got[r["timestamp"]]
        assert g["count"] == r["count"] and g["std"] == pytest.approx(r["std"], rel=1e-6) and g["mean"] == pytest.approx(r["mean"])


def test_stream_routes_late_rows_and_absorbs_them(spark, tmp_path):
    folder, root, whole = (str(tmp_path / n) for n in ("in", "out", "whole"))
    waves = [[(at(i), "S0", 5.0 + i % 9) for i in range(0, 600)], [(at(i) + dt.timedelta(seconds=30), "S0", 50.0) for i in range(100, 140)] + [(at(i), "S1", 7.0) for i in range(590, 700)]]
    for rows in waves:
        table(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        late.run_merging(S.read_stream(spark, folder, DDL), root, C.TEMPERATURE, delay="1 hour")
    assert late.closed_mark(spark, root, "temperature") == at(699) - dt.timedelta(hours=1)
    waiting = late.late_rows(spark, root, "temperature")
    assert waiting.count() == 40 and late.late_rows(spark, root, "temperature", absorbed=False).count() == 40
    update_level(spark, root, "15min", C.TEMPERATURE)
    before = stored(spark, root)
    late.absorb_late(spark, root, C.TEMPERATURE)
    assert late.absorb_late(spark, root, C.TEMPERATURE).count() == 0
    for level in LEVELS:
        update_level(spark, root, level, C.TEMPERATURE)
    run(spark, whole, [r for w in waves for r in w])
    assert stored(spark, root) != before
    for level in LEVELS:
        assert stored(spark, root, level) == stored(spark, whole, level)


def test_empty_delivery(spark, tmp_path):
    run(spark, str(tmp_path), [(at(0), "S0", 3.0)], ["15min"])
    assert deliver(table(spark, []), str(tmp_path), C.TEMPERATURE).count() == 0
    assert len(stored(spark, str(tmp_path))) == 1
