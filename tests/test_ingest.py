import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from lithosense.functions import numeric, text, times
from lithosense.operators import ingest as I
from lithosense.operators.filters import quarantine
from lithosense.schema import CHANNEL_META, CHANNEL_SAMPLE
from lithosense.sources import readers

T = dt.datetime.fromisoformat


def samples(spark, channels):
    rows = [("f", g, c, i, None if v is None else str(v)) for (g, c), values in channels.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, CHANNEL_SAMPLE)


@pytest.mark.parametrize("n", [1, 2, 5, 37, 50, 120])
def test_regrid_equals_interpolation(spark, n):
    clock = np.cumsum(np.random.default_rng(1).random(50) + 0.1)
    y = np.random.default_rng(n).random(n) * 100
    s = samples(spark, {("G", "Time"): clock.tolist(), ("G", "ch"): y.tolist()})
    lengths = I.channel_lengths(s)
    got = [r["value"] for r in I.regrid_linear(s, lengths, I.pick_time_channel(lengths), slice_rows=7).orderBy("idx").collect()]
    want = y if n == 50 else np.interp(clock, np.linspace(clock.min(), clock.max(), n), y) if n > 1 else np.full(50, y[0])
    assert got == pytest.approx(list(want), abs=1e-9)


def test_longest_clock_wins_and_bad_channels_go(spark):
    s = samples(spark, {("A", "Time"): [0, 1], ("B", "Time"): [0, 1, 2], ("C", "Time"): [5, 6, 7], ("A", "x"): [1, "oops"], ("A", "y"): [1, 2]})
    lengths = I.channel_lengths(s)
    assert I.pick_time_channel(lengths).first()["grp"] == "B"
    assert [r["channel"] for r in I.drop_bad_channels(lengths).collect()] == ["y"]


def test_file_to_readings(spark):
    s = samples(spark, {("G", "Time"): [0.0, 0.5, 1.0], ("G", "TM-1"): [1.0, 2.0, 3.0]})
    s = s.withColumn("file", F.lit("/in/2001_01_01/Waterloo_R1_08_02_2023_00_11_22.bin"))
    meta = spark.createDataFrame([("/in/2001_01_01/Waterloo_R1_08_02_2023_00_11_22.bin", "G", "Time", 0, 3, {}, T("2020-01-01"))], CHANNEL_META)
    rows = I.readings_from_channels(s, meta).orderBy("timestamp").collect()
    assert [(r["timestamp"], r["series_id"], r["value"]) for r in rows] == [
        (T("2023-08-02 00:00:00"), "TM-1", 1.0), (T("2023-08-02 00:00:00.5"), "TM-1", 2.0), (T("2023-08-02 00:00:01"), "TM-1", 3.0)]


@pytest.mark.parametrize("name,want", [
    ("Waterloo_R1_08_01_2023_00_11_22.bin", dt.date(2023, 8, 1)), ("x_2023-8-1", dt.date(2023, 8, 1)), ("x_2023_08_09.bin", dt.date(2023, 8, 9)),
    ("x_8_1_2023", dt.date(2023, 8, 1)), ("x-12-31-2022.csv", dt.date(2022, 12, 31)), ("none.bin", None), ("x_2023_13_45", None)])
def test_date_in_file_name(spark, name, want):
    assert spark.createDataFrame([(name,)], "n STRING").select(times.file_date("n")).first()[0] == want


def test_property_beats_file_name(spark):
    df = spark.createDataFrame([("2023-08-02 10:11:12", "x_2020-01-01"), (None, "x_2020-01-01"), (None, "none"), ("nonsense", "none")], "p STRING, n STRING")
    got = [r[0] for r in df.select(times.resolve_start(F.col("p"), F.col("n"), F.lit("2019-05-05 13:00:00").cast("timestamp"))).collect()]
    assert got == [T("2023-08-02 10:11:12"), T("2020-01-01"), T("2019-05-05"), T("2019-05-05")]


def test_station_clock(spark):
    df = spark.createDataFrame([('"2024-01-01 00:00:01 EDT"',), ("2024-01-01 00:00:02 EST",), ("2024-01-01 00:00:03",), ("bad",), (None,), ("2024-13-01 00:00:00",)], "t STRING")
    got = [r[0] for r in df.select(times.station_timestamp("t")).collect()]
    assert got == [T("2024-01-01 00:00:01"), T("2024-01-01 00:00:02"), T("2024-01-01 00:00:03"), None, None, None]


def test_header_choices(spark):
    one = lambda cols, **kw: I.resolve_ts_columns(spark.createDataFrame([tuple(cols.values())], list(cols)), **kw).first()["timestamp"]
    assert one({"Timestamp": "2024-01-01 01:00:00", "timestamp2": "x"}) == T("2024-01-01 01:00:00")
    assert one({"Date": "2024-01-01", "Time": "02:03:04"}) == T("2024-01-01 02:03:04")
    assert one({"Time": "1.5"}, start="2024-01-01 00:00:00") == T("2024-01-01 00:00:01.5")
    with pytest.raises(ValueError):
        one({"v": "1"})
    w = lambda cols: [r["timestamp"] for r in I.resolve_weather_ts(spark.createDataFrame([tuple(cols.values())], list(cols))).collect()]
    assert w({"unixtime": "1704067200"}) == [T("2024-01-01 00:00:00")]
    assert w({"ObsDate": "2024-01-02"}) == [T("2024-01-02")]
    assert w({"v": "1"}) == []


def test_series_names():
    assert I.identify_series(["a_TM-BA-01_x", "temp_2", "Time"]) == (["a_TM-BA-01_x"], [])
    assert I.identify_series(["Temp_2", "Time", "ATM"]) == (["Temp_2", "ATM"], [])


def test_numbers(spark):
    df = spark.createDataFrame([("1.5",), ("NaN",), ("abc",), (None,)], "v STRING")
    assert [r[0] for r in df.select(numeric.to_double("v")).collect()] == [1.5, None, None, None]
    x = spark.createDataFrame([(0.0,), (-1.0,), (-2.0,), (None,)], "x DOUBLE").select(numeric.log1p(F.col("x"))).collect()
    assert x[0][0] == 0.0 and x[1][0] == float("-inf") and x[2][0] != x[2][0] and x[3][0] is None
    m = spark.range(1).select(numeric.midpoints(F.array(F.lit(0.0), F.lit(1.0), F.lit(4.0)))).first()[0]
    assert m == [0.5, 2.5]


def test_material_code(spark):
    df = spark.createDataFrame([("Fine-Grained: clay",), ("Rock",), (None,)], "m STRING")
    assert [r[0] for r in df.select(text.material_code(F.col("m"))).collect()] == [2, 1, 2]
    assert [tuple(r) for r in df.select(*text.material_parts(F.col("m"))).collect()] == [("Fine-Grained", "clay"), ("Rock", None), (None, None)]


def test_quarantine_keeps_every_row(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y"), (2, None)], "a INT, b STRING")
    good, bad = quarantine(df, {"a": F.col("a").isNull(), "b": F.col("b").isNull()})
    assert good.count() == 1 and sorted(r["reason"] for r in bad.collect()) == ["a", "b"]


def test_station_folder_first_file_wins(spark, tmp_path):
    head = "date_time_local,temperature,station\n"
    (tmp_path / "a.csv").write_text(head + "2024-01-01 00:00:00 EST,1.5,q\nbroken,9,q\n")
    (tmp_path / "b.csv").write_text(head + "2024-01-01 00:00:00 EST,7,q\n2024-01-01 00:10:00 EST,n/a,q\n")
    rows = {r["timestamp"]: r["temperature"] for r in readers.scan_weather_dir(spark, str(tmp_path)).collect()}
    assert rows == {T("2024-01-01 00:00:00"): 1.5, T("2024-01-01 00:10:00"): None}


def test_heads_of_files_are_found_without_sorting_lines(spark, tmp_path, capsys):
    from lithosense.sources.readers import file_heads

    for name, lines in (("a", ["x,y", "1,2", "0,0"]), ("b", ["y,x", "3,4"]), ("c", ["x,y"]), ("d", [])):
        (tmp_path / f"{name}.csv").write_text("".join(f"{line}\n" for line in lines))
    heads = file_heads(spark, str(tmp_path))
    heads.explain()
    plan = capsys.readouterr().out
    assert "SortAggregate" not in plan and "Sort " not in plan
    assert sorted((r["file"][-5:], r["head"]) for r in heads.collect()) == [("a.csv", "x,y"), ("b.csv", "y,x"), ("c.csv", "x,y")]
