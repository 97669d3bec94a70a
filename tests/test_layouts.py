"""Clustered tables, sketches, quantiles of groups, wider stream windows."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from lithosense.operators import sketches
from lithosense.operators.quantiles import group_quantiles
from lithosense.registry.base import Tables
from lithosense.sources import clustered, warehouse


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clustered_tables_need_no_exchange(spark, sf, tmp_path):
    t = Tables(spark, sf)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        reads = clustered.write_clustered(t.readings(), "cl_readings", 4, path=str(tmp_path / "r"))
        dim = clustered.write_clustered(t.dim().withColumnRenamed("sensor_id", "series_id"), "cl_dim", 4, order=(), path=str(tmp_path / "d"))
        series = Window.partitionBy("series_id").orderBy("timestamp", "event_id")
        lag = reads.withColumn("before", F.lag("value").over(series))
        joined = reads.join(dim, "series_id")
        latest = reads.groupBy("series_id").agg(F.max_by("value", "timestamp").alias("value"))
        for df in (lag, joined, latest):
            assert "Exchange" not in plan(df)
        assert "Exchange" in plan(t.readings().withColumn("before", F.lag("value").over(series)))
        assert joined.count() == t.readings().join(t.dim(), F.col("series_id") == F.col("sensor_id")).count()
        assert len(list((tmp_path / "r").glob("*.parquet"))) == 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("cl_readings", "cl_dim"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_warehouse_tables_can_be_clustered(spark, tmp_path):
    warehouse.create_schema(spark, "clustered_schema", str(tmp_path), buckets=4)
    try:
        facts = spark.sql("DESCRIBE EXTENDED clustered_schema.TempDataHourly").collect()
        said = {r["col_name"]: r["data_type"] for r in facts}
        assert said["Num Buckets"] == "4" and "SensorID" in said["Bucket Columns"]
    finally:
        spark.sql("DROP DATABASE clustered_schema CASCADE")


def test_sketches_merge_to_the_direct_one(spark):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), f"S{m % 2}", (m * 7919) % 4001) for m in range(0, 60 * 24 * 9, 2)]
    df = spark.createDataFrame(rows, "timestamp TIMESTAMP_NTZ, series_id STRING, value INT")
    weeks = sketches.with_estimate(sketches.weekly_sketches(sketches.daily_sketches(sketches.hourly_sketches(df, "value"))))
    direct = df.groupBy(F.date_sub(F.col("timestamp").cast("date"), F.weekday(F.col("timestamp").cast("date"))).alias("week_start"), "series_id")
    direct = direct.agg(sketches.distinct_estimate(sketches.distinct_sketch("value")).alias("d"), F.count_distinct("value").alias("exact"), F.count("value").alias("m"))
    both = weeks.join(direct, ["week_start", "series_id"]).collect()
    assert len(both) == weeks.count() > 0
    for r in both:
        # a union is read by another estimator than a sketch that saw every value
        assert r["n"] == r["m"] and all(abs(x - r["exact"]) <= 0.03 * r["exact"] for x in (r["d"], r["distinct"]))


def test_group_quantiles_against_numpy(spark):
    import numpy as np

    r = random.Random(5)
    rows = [("hot", 1, r.choice([0.0, 0.0, r.random()])) for _ in range(3000)] + [("a", None, float(k)) for k in range(7)] + [(None, 1, 5.0), ("nan", 1, float("nan")), ("none", 1, None)]
    df = spark.createDataFrame(rows, "g STRING, h INT, v DOUBLE")
    got = {(x["g"], x["h"]): x for x in group_quantiles(df, ["g", "h"], "v", [0.0, 0.05, 0.5, 0.953, 1.0], ["a0", "a5", "a50", "a95", "a100"]).collect()}
    assert set(got) == {("hot", 1), ("a", None), (None, 1)}
    for key in got:
        values = [v for g, h, v in rows if (g, h) == key]
        assert [got[key][c] for c in ("a0", "a5", "a50", "a95", "a100")] == pytest.approx(list(np.quantile(values, [0, 0.05, 0.5, 0.953, 1])))
        assert got[key]["n"] == len(values)
    assert group_quantiles(df.limit(0), ["g"], "v", [0.5]).count() == 0
