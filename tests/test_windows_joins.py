import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from lithosense.operators import joins, sets
from lithosense.operators.quantiles import exact_quantiles, modes
from lithosense.operators.windows import dedup_first, dense_index, latest_per_series, with_previous

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def bursts(spark):
    """One series holds most rows; bursts, long gaps, and equal instants."""
    rng = random.Random(5)
    rows, at = [], START
    for i in range(3000):
        at += dt.timedelta(seconds=rng.choice([0, 0, 1, 5, 400, 9000, 4_000_000] if i % 50 == 0 else [0, 1, 2, 3]))
        rows.append((at, "hot" if rng.random() < 0.8 else rng.choice("ab"), rng.random(), i))
    return spark.createDataFrame(rows, "timestamp TIMESTAMP_NTZ, series_id STRING, value DOUBLE, id BIGINT").cache()


@pytest.mark.parametrize("slices", [("1 minute", "1 hour", "30 days"), ("1 hour", "30 days"), ("1 day",)])
def test_sliced_previous_equals_plain_lag(bursts, slices):
    plain = bursts.withColumn("want", F.lag(F.struct("timestamp", "value")).over(Window.partitionBy("series_id").orderBy("timestamp", "id")))
    got = with_previous(bursts, tiebreak=("id",), slices=slices)
    both = plain.join(got.select("id", "prev"), "id")
    assert both.count() == 3000
    assert both.where(~F.col("want").eqNullSafe(F.col("prev"))).count() == 0


def test_dense_index_counts_up_per_series(bursts):
    want = bursts.withColumn("w", F.row_number().over(Window.partitionBy("series_id").orderBy("timestamp", "id")) - 1)
    got = dense_index(bursts, ["series_id"], "timestamp", ("id",)).select("id", "idx")
    assert want.join(got, "id").where("w = idx").count() == 3000


def test_dedup_keeps_first_and_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(1, "b", 2, "x"), (1, "b", 1, "y"), (None, "c", 5, "z"), (None, "c", 4, "w")], "k INT, s STRING, pos INT, v STRING")
    got = {(r["k"], r["s"]): r["v"] for r in dedup_first(df, ["k", "s"], ["pos"]).collect()}
    assert got == {(1, "b"): "y", (None, "c"): "w"}


def test_latest_breaks_ties(spark):
    df = spark.createDataFrame([("a", START, 1.0, 1), ("a", START, 2.0, 2)], "series_id STRING, timestamp TIMESTAMP_NTZ, value DOUBLE, id INT")
    assert latest_per_series(df, tiebreak=("id",)).first()["latest_value"] == 2.0


def test_outer_merge_with_null_keys_in_both_modes(spark):
    a = spark.createDataFrame([(1, "x"), (None, "n"), (2, "y")], "k INT, v STRING")
    b = spark.createDataFrame([(1, "p"), (None, "m"), (3, "q")], "k INT, v STRING")
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(joins.merge(a, b, ["k"], "outer")) == sorted([(1, "x", "p"), (None, "n", None), (2, "y", None), (None, None, "m"), (3, None, "q")], key=str)
    assert rows(joins.merge(a, b, ["k"], "outer", null_safe=True)) == sorted([(1, "x", "p"), (None, "n", "m"), (2, "y", None), (3, None, "q")], key=str)
    assert rows(joins.merge(a, b, ["k"], "left", null_safe=True)) == sorted([(1, "x", "p"), (None, "n", "m"), (2, "y", None)], key=str)


def test_outer_merge_equals_full_outer_on_skewed_duplicates(spark):
    a = spark.range(400).select((F.col("id") % 7 * (F.col("id") % 3)).alias("k"), F.col("id").alias("x"))
    b = spark.range(90).select((F.col("id") % 11).alias("k"), F.col("id").alias("y"))
    want = a.join(b, "k", "outer").select("k", "x", "y")
    got = joins.merge(a, b, ["k"], "outer").select("k", "x", "y")
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0


def test_ranked_pairs(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 2.0)], "f STRING, s DOUBLE")
    assert [tuple(r) for r in sets.ranked_pairs(df, "f", "s").collect()] == [("b", "c"), ("b", "a"), ("c", "a")]


@pytest.mark.parametrize("kind", ["uniform", "dup", "heavy_tail", "constant"])
@pytest.mark.parametrize("limit", [10, 200, 10**6])
def test_exact_quantiles_equal_numpy(spark, kind, limit):
    import numpy as np

    rng = np.random.default_rng(3)
    x = {
        "uniform": rng.random(5000), "dup": rng.integers(0, 4, 5000).astype(float),
        "heavy_tail": np.exp(rng.normal(size=5000) * 8), "constant": np.full(5000, 2.5),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x DOUBLE").repartition(8)
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = exact_quantiles(df, ["x"], probs, limit=limit)["x"]
    assert got == pytest.approx(np.percentile(x, [p * 100 for p in probs]).tolist(), rel=1e-9)


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([], "x DOUBLE"), ["x"], [0.5]) == {"x": [None]}


def test_mode_is_smallest_of_the_most_frequent(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,), (None,), (None,)], "m STRING")
    assert modes(df, ["m"]).first()["mode"] == "a"
