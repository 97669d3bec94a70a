"""The physical plans hold at scale: no Python rows, no cross products, no global windows."""

import re

import pytest
from pyspark.sql import functions as F

from lithosense.operators import rollup as R
from lithosense.operators.windows import dedup_first, with_previous
from lithosense.plans import cascade as C
from lithosense.registry import QUERIES
from lithosense.registry.base import Tables

# Queries that fit models or write tables act when built; their result plans are small.
ACTING = {
    "cv_kfold", "cv_shuffle", "explain_local", "fit_additive", "fit_ensemble", "fit_forest", "forest_report", "grid_search", "halving_search", "hash_split",
    "importance_additive", "importance_forest", "interaction_pairs", "pair_table", "pred_vs_actual", "random_search", "shape_table", "tree_curve", "tree_dump",
}
LAZY = sorted(set(QUERIES) - ACTING)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_bad_nodes(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "CollectLimit"):
        assert node not in text, f"{node} in plan"
    for window in re.finditer(r"Window \[", text):
        below = text[window.start(): window.start() + 2500]
        assert "Exchange SinglePartition" not in below.split("Exchange", 2)[0] + "Exchange" + below.split("Exchange", 2)[1][:60] if below.count("Exchange") else True


def exchanges(df) -> list[str]:
    return re.findall(r"Exchange (\w+)", plan(df))


def test_rollup_combines_before_the_shuffle_and_prunes(spark, sf):
    df = R.rollup_15min(Tables(spark, sf).dense().drop("event_id"))
    text = plan(df)
    assert exchanges(df) == ["hashpartitioning"]
    assert text.count("HashAggregate") == 2 and "partial_stddev" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text


def test_four_levels_need_two_shuffles(spark, sf):
    df = C.cascade(Tables(spark, sf).dense(), C.TEMPERATURE)["weekly"]
    assert exchanges(df) == ["hashpartitioning"] * 2
    assert "hashpartitioning(series_id" in plan(df)


def test_previous_reading_shuffles_rows_once(spark, sf):
    events = Tables(spark, sf).dense()
    text = plan(with_previous(events, tiebreak=("event_id",)))
    # One exchange carries the rows; the others carry one row per slice.
    assert "value" in text
    wide = [line for line in text.splitlines() if "Exchange hashpartitioning(series_id" in line]
    assert len(wide) <= 6


def test_dedup_combines_before_the_shuffle(spark, sf):
    text = plan(dedup_first(Tables(spark, sf).events, ["user_id"], ["ts", "event_id"]))
    assert "partial_min_by" in text and "Window" not in text


def test_closed_bucket_filter_reaches_the_scan(spark, sf, tmp_path):
    from lithosense.operators.filters import closed_buckets

    path = str(tmp_path / "h")
    R.rollup_hourly(R.rollup_15min(Tables(spark, sf).dense())).write.parquet(path)
    text = plan(closed_buckets(spark.read.parquet(path), "hourly", "2024-01-20 10:20:00"))
    assert "LessThanOrEqual(timestamp,2024-01-20T09:20" in text


def test_day_filter_prunes_partitions(spark, sf, tmp_path):
    from lithosense.sources.sinks import write_rollup

    path = write_rollup(R.rollup_15min(Tables(spark, sf).dense()), str(tmp_path), "15min")
    text = plan(spark.read.parquet(path).where(F.col("day") == "2024-01-05"))
    assert re.search(r"PartitionFilters: \[.*day", text)
