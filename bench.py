"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run once to warm up and then ``BENCH_RUNS`` times; the best time counts.
``rollup_24m`` repeats the recorded workload of the source pipeline (24.6 million
sensor cells to 15-minute statistics): the events table laid out 1,169,702 / n times
in a row as a wide frame of 21 channels, stored as Parquet, then aggregated.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, functions as F

from lithosense.operators.rollup import rollup_15min, rollup_15min_wide
from lithosense.registry import QUERIES
from lithosense.session import build_session, scratch_path

HEADLINE = (
    "rollup_15min", "rollup_hourly", "cascade", "daily_sensor_vs_weather", "weekly_temp_weather", "latest_readings_view",
    "rate_per_hour", "dedup_first", "regrid_linear", "build_section_table", "climate_traffic_report", "ensemble_weights",
    "corr_matrix", "percentiles", "gradient_weekly", "sensor_health",
)
ROWS, CHANNELS = 1_169_702, 21


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run, repeats: int) -> float:
    run()
    best = float("inf")
    for _ in range(repeats):
        start = time.perf_counter()
        run()
        best = min(best, time.perf_counter() - start)
    return round(best, 4)


def wide_frame(spark, sf_dir: str) -> str:
    """About 1.17 million rows × 21 channels derived from the events table."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("ts", "value")
    n = events.count()
    copies = -(-ROWS // n)
    micros = F.col("copy") * F.lit(30 * 86_400_000_000)
    rows = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(
        F.timestamp_add("MICROSECOND", (micros + F.timestamp_diff("MICROSECOND", F.lit("2024-01-01").cast("timestamp_ntz"), "ts")) / 200,
                        F.lit("2024-01-01").cast("timestamp_ntz")).alias("timestamp"),
        *[(F.col("value") + F.lit(i / 10)).alias(f"TM-{i:02d}") for i in range(CHANNELS)],
    ).limit(ROWS)
    path = scratch_path(spark, "bench-wide")
    rows.repartition(16).write.parquet(path)
    return path


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: timed(lambda name=name: consume(QUERIES[name](spark, sf_dir)), repeats) for name in HEADLINE}
    if os.environ.get("BENCH_WIDE", "1") == "1":
        path = wide_frame(spark, sf_dir)
        names = [f"TM-{i:02d}" for i in range(CHANNELS)]
        wide = spark.read.parquet(path)
        times["rollup_24m_wide"] = timed(lambda: consume(rollup_15min_wide(wide, names)), repeats)
        long = wide.unpivot(["timestamp"], names, "series_id", "value")
        times["rollup_24m_long"] = timed(lambda: consume(rollup_15min(long)), repeats)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline queries, total of best runs", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf"), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
