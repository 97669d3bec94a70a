"""Stored parts of the 15-minute level, so that deliveries add to a bucket instead of replacing it.

A part holds what one delivery says about one bucket of a series: count, mean, sum of
squared differences from that mean (``m2``), minimum and maximum.  Parts of a bucket merge
into its statistics without the readings, however many deliveries it took:

    n = Σn_i    mean = Σ n_i·mean_i / n    m2 = Σ m2_i + Σ n_i·(mean_i − mean)²

A part is stored under its delivery's id, so a delivery that comes again replaces its own
parts and is not counted twice.  Deliveries with readings in common need ``unseen`` first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lithosense.functions.times import bucket_start
from lithosense.operators.filters import active_filter
from lithosense.plans import cascade as C
from lithosense.session import materialise
from lithosense.sources import sinks

KEY = ["timestamp", "series_id"]
SCHEMA = "timestamp TIMESTAMP_NTZ, series_id STRING, delivery STRING, n BIGINT, mean DOUBLE, m2 DOUBLE, min DOUBLE, max DOUBLE, day DATE"
STORED = "stored"  # the part made of a level that was stored without parts


def path_of(root: str, kind: str) -> str:
    return f"{root}/_parts/kind={kind}"


def fingerprint(readings: DataFrame) -> Column:
    """An id for a delivery that has none: its size and the sum of its rows' hashes, the same in any order."""
    rows = readings.select("timestamp", "series_id", "value")
    total = rows.agg(
        F.concat_ws("-", F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("timestamp", "series_id", "value").cast("decimal(38,0)")), F.lit(0))).alias("id")
    )
    return total.scalar()


def parts_of(readings: DataFrame, rules: C.Rules) -> DataFrame:
    """Parts of delivered readings.  A column ``delivery`` (say, the file) tells deliveries apart; without it they are one."""
    if "delivery" not in readings.columns:
        readings = readings.withColumn("delivery", fingerprint(readings))
    src = readings if rules.threshold is None else active_filter(readings, rules.threshold)
    bucketed = src.where("timestamp IS NOT NULL AND value IS NOT NULL").select(
        bucket_start("timestamp", "15 minutes").alias("timestamp"), "series_id", F.col("delivery").cast("string").alias("delivery"), "value"
    )
    return bucketed.groupBy(*KEY, "delivery").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), (F.var_pop("value") * F.count("value")).alias("m2"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )


def as_parts(level: DataFrame) -> DataFrame:
    """A stored 15-minute level as parts of one delivery."""
    m2 = F.coalesce(F.col("std") * F.col("std") * (F.col("count") - 1), F.lit(0.0))
    return level.select(*KEY, F.lit(STORED).alias("delivery"), F.col("count").alias("n"), "mean", m2.alias("m2"), "min", "max")


def merged(parts: DataFrame, rules: C.Rules) -> DataFrame:
    """The 15-minute level that parts add up to.

    Means are centred on the bucket's own before they are squared, so a small spread far
    from zero is kept.  Window and aggregation share one shuffle.
    """
    bucket = Window.partitionBy(*KEY)
    centre = F.sum(F.col("n") * F.col("mean")).over(bucket) / F.sum("n").over(bucket)
    off = F.col("mean") - F.col("centre")
    rows = parts.withColumn("centre", centre).groupBy(*KEY).agg(
        F.max("centre").alias("mean"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"), F.sum("n").alias("count"),
    )
    std = F.when(F.col("count") > 1, F.sqrt(F.col("m2") / (F.col("count") - 1)))
    if rules.null_std == "zero":
        std = F.coalesce(std, F.lit(0.0))
    return rows.select(*KEY, "mean", "min", "max", std.alias("std"), "count")


def read_parts(spark: SparkSession, root: str, kind: str) -> DataFrame:
    path = path_of(root, kind)
    if not sinks.exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def _close(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= 1e-9 * F.greatest(F.lit(1.0), F.abs(a))


def _same_part() -> Column:
    return (F.col("timestamp") == F.col("_timestamp")) & F.col("series_id").eqNullSafe(F.col("_series_id")) & F.col("delivery").eqNullSafe(F.col("_delivery"))


def changed(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Rows of ``fresh`` that add to or differ from the stored part of the same delivery (sums may differ in their last bits)."""
    was = stored.select(*[F.col(c).alias(f"_{c}") for c in (*KEY, "delivery", "n", "mean", "m2", "min", "max")])
    same = (F.col("n") == F.col("_n")) & (F.col("min") == F.col("_min")) & (F.col("max") == F.col("_max"))
    same = same & _close(F.col("_mean"), F.col("mean")) & _close(F.col("_m2"), F.col("m2"))
    return fresh.join(was, _same_part(), "left").where(~F.coalesce(same, F.lit(False))).select(*fresh.columns)


def unseen(readings: DataFrame, root: str, kind: str) -> DataFrame:
    """Readings whose (instant, series) no earlier delivery held; they are noted as seen.

    For deliveries that overlap (exports of moving periods).  Of several readings of one
    instant in a delivery the least value counts.  Only the days delivered are read.  Keys
    are noted under their delivery, so a delivery that comes again gets the same answer.
    """
    spark = readings.sparkSession
    if "delivery" not in readings.columns:
        readings = readings.withColumn("delivery", fingerprint(readings))
    once = readings.where("timestamp IS NOT NULL").groupBy("timestamp", "series_id").agg(F.min(F.struct("delivery", "value")).alias("r"))
    rows = materialise(once.select("timestamp", "series_id", "r.value", "r.delivery", F.col("timestamp").cast("date").alias("day")), "delivered")
    path = f"{root}/_seen/kind={kind}"
    if sinks.exists(spark, path):
        days = rows.select("day").distinct()
        seen = spark.read.schema("timestamp TIMESTAMP_NTZ, series_id STRING, delivery STRING, day DATE").parquet(path).join(days, "day", "left_semi")
        seen = seen.select(F.col("timestamp").alias("_t"), F.col("series_id").alias("_s"), F.col("delivery").alias("_d"))
        other = (F.col("timestamp") == F.col("_t")) & F.col("series_id").eqNullSafe(F.col("_s")) & ~F.col("delivery").eqNullSafe(F.col("_d"))
        mine = (F.col("timestamp") == F.col("_t")) & F.col("series_id").eqNullSafe(F.col("_s")) & F.col("delivery").eqNullSafe(F.col("_d"))
        rows = materialise(rows.join(seen, other, "left_anti"), "unseen")
        fresh = rows.join(seen, mine, "left_anti")
    else:
        fresh = rows
    fresh = materialise(fresh.select("timestamp", "series_id", "delivery", "day"), "newly-seen")
    fresh.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(path)
    return rows.drop("day")


def add(readings: DataFrame, root: str, rules: C.Rules, level: DataFrame | None = None, note: Callable | None = None, replace_days: bool = False) -> DataFrame:
    """Store the parts of a delivery; returns ``day`` of those that are new or different.

    Only touched day partitions are read and rewritten.  ``level`` is the stored 15-minute
    level with ``day``: buckets that it has without parts become parts first.  ``note`` is
    given the days before anything is stored, so a run that breaks off can be made good.
    ``replace_days`` forgets what these days held before.
    """
    spark = readings.sparkSession
    day = F.col("timestamp").cast("date")
    fresh = materialise(parts_of(readings, rules).withColumn("day", day), "parts")
    rows = differing = fresh
    if not replace_days:
        touched = fresh.select("day").distinct()
        stored = read_parts(spark, root, rules.kind).join(touched, "day", "left_semi").select(*fresh.columns)
        if level is not None:
            known = stored.select(F.col("timestamp").alias("_t"), F.col("series_id").alias("_s"))
            bare = as_parts(level.join(touched, "day", "left_semi")).withColumn("day", day)
            bare = bare.join(known, (F.col("timestamp") == F.col("_t")) & F.col("series_id").eqNullSafe(F.col("_s")), "left_anti")
            stored = stored.unionByName(bare.select(*fresh.columns))
        stored = materialise(stored, "stored-parts")
        differing = changed(stored, fresh)
        again = fresh.select(*[F.col(c).alias(f"_{c}") for c in (*KEY, "delivery")])
        rows = stored.join(again, _same_part(), "left_anti").unionByName(fresh)
    days = materialise(differing.select("day").distinct(), "changed-days")
    rows = materialise(rows.join(days, "day", "left_semi"), "new-parts")
    if note:
        note(days)
    (
        rows.select(*[c for c in fresh.columns if c != "day"], "day").hint("rebalance", "day")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path_of(root, rules.kind))
    )
    return days
