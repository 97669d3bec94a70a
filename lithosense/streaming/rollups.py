"""Streaming roll-ups.  Event time must be TIMESTAMP, so readings are cast from NTZ
under the UTC session and results cast back; wall-clock values are unchanged.

Late data: rows older than the watermark are left out of the open stream.  To take
them in, run ``plans.cascade.level_of`` over the affected days and store with
``sinks.write_rollup``, which replaces exactly those day partitions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lithosense.constants import ZERO_THRESHOLD
from lithosense.operators.rollup import STATS, coarse_stats, named, rollup_15min
from lithosense.session import scratch_path
from lithosense.sources.sinks import upsert


def read_stream(spark: SparkSession, folder: str, schema: str, glob: str | None = None, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files of a folder as a stream, bounded work per micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(folder)


def watermarked(readings: DataFrame, delay: str) -> DataFrame:
    return readings.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", delay)


def _fifteen(readings: DataFrame, delay: str, threshold: float | None) -> DataFrame:
    src = watermarked(readings, delay).where(F.col("value").isNotNull())
    if threshold is not None:
        src = src.where(F.abs("value") > threshold)
    return src.groupBy(F.window("timestamp", "15 minutes").alias("w"), "series_id").agg(
        F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.stddev_samp("value").alias("std"), F.count("value").alias("count"),
    )


def _flat(df: DataFrame) -> DataFrame:
    return df.select(F.col("w.start").cast("timestamp_ntz").alias("timestamp"), "series_id", "mean", "min", "max", "std", "count")


def stream_rollup_15min(readings: DataFrame, delay: str = "1 hour", threshold: float | None = ZERO_THRESHOLD) -> DataFrame:
    """15-minute statistics; in append mode a bucket appears once, when it is closed."""
    return _flat(_fifteen(readings, delay, threshold))


def stream_hourly(
    readings: DataFrame, delay: str = "1 hour", threshold: float | None = ZERO_THRESHOLD, null_std: str = "propagate"
) -> DataFrame:
    """Hours from closed quarters within one query (chained windows)."""
    hours = named(
        _fifteen(readings, delay, threshold)
        .groupBy(F.window(F.window_time("w"), "1 hour").alias("h"), "series_id")
        .agg(*coarse_stats(null_std))
    )
    return _flat(hours.withColumnRenamed("h", "w"))


def _next_window(finer: DataFrame, width: str, null_std: str, start: str | None = None, *more) -> DataFrame:
    """Closed windows of a finer level gathered in wider ones."""
    window = F.window(F.window_time("w"), width, startTime=start) if start else F.window(F.window_time("w"), width)
    return named(finer.groupBy(window.alias("x"), "series_id").agg(*more, *coarse_stats(null_std))).withColumnRenamed("x", "w")


def _days(readings: DataFrame, delay: str, threshold: float | None, null_std: str) -> DataFrame:
    hours = _next_window(_fifteen(readings, delay, threshold), "1 hour", null_std)
    return _next_window(hours, "1 day", null_std)


def stream_daily(
    readings: DataFrame, delay: str = "1 hour", threshold: float | None = ZERO_THRESHOLD, null_std: str = "propagate"
) -> DataFrame:
    """Days from closed hours from closed quarters, within one query."""
    days = _days(readings, delay, threshold, null_std)
    return days.select(
        F.col("w.start").cast("timestamp_ntz").cast("date").alias("date"), "series_id", *STATS, (F.col("max") - F.col("min")).alias("temp_range")
    )


def stream_weekly(
    readings: DataFrame, delay: str = "1 hour", threshold: float | None = ZERO_THRESHOLD, null_std: str = "propagate", week_end: str = "data"
) -> DataFrame:
    """Monday weeks from closed days; ``week_end`` as in ``rollup_weekly``."""
    days = _days(readings, delay, threshold, null_std)
    if week_end == "data":
        days = days.where(F.col("std").isNotNull())
    last = F.max(F.col("w.start").cast("timestamp_ntz").cast("date")).alias("last")
    # the epoch was a Thursday: weeks from Monday start four days on
    weeks = _next_window(days, "7 days", null_std, "4 days", last)
    monday = F.col("w.start").cast("timestamp_ntz").cast("date")
    end = F.col("last") if week_end == "data" else F.date_add(monday, 6)
    return weeks.select(monday.alias("week_start"), end.alias("week_end"), "series_id", *STATS, (F.col("max") - F.col("min")).alias("temp_range"))


def stream_dedup(readings: DataFrame, delay: str = "1 hour", keys: tuple[str, ...] = ("timestamp", "series_id")) -> DataFrame:
    """One row per (instant, series); state per key is dropped with the watermark."""
    return watermarked(readings, delay).dropDuplicatesWithinWatermark(list(keys)).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    )


def close_15min(closed: DataFrame, readings: DataFrame, threshold: float | None = ZERO_THRESHOLD) -> DataFrame:
    """All 15-minute rows once the stream has ended: those it emitted, and the buckets still open.

    The open buckets are rolled up in batch from the readings; store the result with
    ``sinks.write_rollup``, which replaces whole days.
    """
    whole = rollup_15min(readings, threshold=threshold)
    return closed.unionByName(whole.join(closed.select("timestamp", "series_id"), ["timestamp", "series_id"], "left_anti").select(*closed.columns))


def _large_state(spark: SparkSession) -> None:
    """Keep operator state in RocksDB: on local disk with changelog checkpoints in the
    shared folder, instead of in executor heap."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def checkpoint_of(path: str) -> str:
    """The checkpoint that belongs to a target table."""
    return f"{path.rstrip('/')}.checkpoint"


def run_to_table(stream: DataFrame, label: str, path: str | None = None, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Process everything new, write to a Parquet table, and return that table.

    The checkpoint lies beside the table unless given: a later run on the same ``path``
    goes on where the last one stopped, also after the driver was lost.
    """
    spark = stream.sparkSession
    _large_state(spark)
    path = path or scratch_path(spark, label)
    query = (
        stream.writeStream.format("parquet").outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint or checkpoint_of(path))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def run_upsert(stream: DataFrame, path: str, keys: list[str], partition: str, prepare: Callable | None = None, checkpoint: str | None = None) -> None:
    """Replace-by-key per micro-batch.  Re-running a batch after a failure gives the
    same table, because an upsert of the same rows changes nothing.  The checkpoint lies
    beside the table unless given, so a later run takes new input only."""
    def apply(batch: DataFrame, _: int) -> None:
        rows = prepare(batch) if prepare else batch
        upsert(rows, path, keys, partition)

    spark = stream.sparkSession
    _large_state(spark)
    (
        stream.writeStream.foreachBatch(apply).outputMode("update")
        .option("checkpointLocation", checkpoint or checkpoint_of(path))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
