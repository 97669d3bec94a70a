"""What keeps work in proportion to the rows: passes, hashes, sizes of tasks."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lithosense.models import boosting as B, prepare as P
from lithosense.operators import joins, summaries
from tests.test_plans import plan


def test_spread_bounds_the_rows_of_a_task(spark):
    rows = P.spread(spark.range(1000).coalesce(1), rows_per_task=100)
    sizes = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 150


def test_every_bag_hashes_a_row_once(spark):
    rows = spark.range(500).withColumn("x", F.col("id") % 3)
    counts = B.bag_counts(rows, ["id", "x"], 3)
    assert plan(counts).count("md5(") <= 2 * 3
    one = rows.groupBy(B.bag_weight(["id", "x"], 1).alias("w")).count().collect()
    assert {r["weight"]: r["n"] for r in counts.where("bag = 1").collect()} == {r["w"]: r["count"] for r in one}


def test_sums_repeat_no_row(spark):
    data = spark.range(300).select("id", (F.col("id") % 3).alias("a"), (F.col("id") % 4).alias("b"), F.when(F.col("id") % 7 > 0, F.col("id") * 0.5).alias("y"))
    found = B.sums(data, ["a", "b"], [3, 4], "y", ["id"], B.Boosting(bags=0))
    assert "Generate explode" not in plan(found)
    cells = {(r["i"], r["j"]): r for r in found.collect()}
    assert cells[1, 3 + 2]["learn"] == sum(i % 3 == 1 and i % 4 == 2 for i in range(300))
    mine = [i * 0.5 for i in range(300) if i % 3 == 2 and i % 7]
    assert cells[2, 2]["learn"] == 100 and cells[2, 2]["learn_y"] == pytest.approx(sum(mine)) and cells[2, 2]["judge_yy"] == pytest.approx(sum(v * v for v in mine))


def test_correlations_of_all_pairs_in_one_pass(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=400) + 1e6
    b = a * 0.5 + rng.normal(size=400)
    rows = [(float(x), float(y) if k % 5 else None, 0.1, None if k else 3.0) for k, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, same DOUBLE, once DOUBLE").repartition(5)
    result = summaries.corr_matrix(df, ["a", "b", "same", "once"])
    assert "corr(" not in plan(result)
    found = {(r["a"], r["b"]): r["r"] for r in result.collect()}
    kept = [k for k in range(400) if k % 5]
    assert len(found) == 6 and found["a", "b"] == pytest.approx(np.corrcoef(a[kept], b[kept])[0, 1], abs=1e-9)
    assert found["a", "same"] is None and found["a", "once"] is None
    empty = summaries.corr_matrix(df.limit(0), ["a", "b"]).collect()
    assert [tuple(r) for r in empty] == [("a", "b", None)]
    with_nan = spark.createDataFrame([(1.0, 2.0), (2.0, math.nan), (3.0, 1.0)], "a DOUBLE, b DOUBLE")
    assert math.isnan(summaries.corr_matrix(with_nan, ["a", "b"]).first()["r"])


def test_means_of_few_keys_bring_no_rows_to_one_task(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") * 1.0).alias("v"))
    filled = joins.group_mean_fallback(rows, rows, "k", ["v"])
    assert "SortMergeJoin" not in plan(filled) and "BroadcastHashJoin" in plan(filled)
    assert filled.where("v IS NULL").isEmpty() and filled.count() == 1000
