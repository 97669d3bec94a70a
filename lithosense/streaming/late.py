"""Readings from a stream into stored parts, late ones by way of a table of their own.

Each micro-batch is merged into the parts of the 15-minute level under its own number, so a
batch that is run again is not counted twice.  A reading of a bucket that had closed before
its batch (the newest instant seen less ``delay``) goes to a late table instead: what is
published up to the mark stays as it is until ``absorb_late`` takes the late rows in.
Nothing is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lithosense.functions.times import bucket_start
from lithosense.plans import cascade as C
from lithosense.plans.incremental import deliver
from lithosense.session import materialise
from lithosense.sources import sinks

_MARKS = "batch BIGINT, mark TIMESTAMP_NTZ"
_LATE = "timestamp TIMESTAMP_NTZ, series_id STRING, value DOUBLE, batch BIGINT"


def _marks_path(root: str, kind: str, name: str) -> str:
    return f"{root}/_stream/kind={kind}/{name}/marks"


def late_path(root: str, kind: str, name: str) -> str:
    return f"{root}/_stream/kind={kind}/{name}/late"


def closed_mark(spark: SparkSession, root: str, kind: str, name: str = "readings", before: int | None = None):
    """The instant up to which buckets are closed (before a batch, if given); None at the start."""
    path = _marks_path(root, kind, name)
    if not sinks.exists(spark, path):
        return None
    marks = spark.read.schema(_MARKS).parquet(path)
    if before is not None:
        marks = marks.where(F.col("batch") < before)
    return marks.agg(F.max("mark")).first()[0]


def run_merging(stream: DataFrame, root: str, rules: C.Rules, delay: str = "1 hour", name: str = "readings") -> None:
    """Take in everything new of a stream of ``timestamp, series_id, value``.

    A later run with the same ``root`` and ``name`` goes on where the last one stopped.
    """
    spark = stream.sparkSession

    def apply(batch: DataFrame, number: int) -> None:
        mark = closed_mark(spark, root, rules.kind, name, before=number)
        rows = materialise(batch.select("timestamp", "series_id", F.col("value").cast("double").alias("value")), "batch")
        closed = F.lit(mark).cast("timestamp_ntz")
        late = F.coalesce(F.timestamp_add("MINUTE", F.lit(15), bucket_start("timestamp", "15 minutes")) <= closed, F.lit(False))
        rows.where(late).coalesce(1).write.mode("overwrite").parquet(f"{late_path(root, rules.kind, name)}/batch={number}")
        deliver(rows.where(~late).withColumn("delivery", F.lit(f"{name}-{number}")), root, rules)
        seen = (F.max("timestamp") - F.expr(f"INTERVAL {delay}")).cast("timestamp_ntz")
        new = rows.agg(F.greatest(seen, closed).alias("mark")).where("mark IS NOT NULL")
        new.coalesce(1).write.mode("overwrite").parquet(f"{_marks_path(root, rules.kind, name)}/batch={number}")

    (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", f"{root}/_stream/kind={rules.kind}/{name}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def late_rows(spark: SparkSession, root: str, kind: str, name: str = "readings", absorbed: bool = True) -> DataFrame:
    """The late table with the ``batch`` of each row; without those that are ``absorbed``, if wanted."""
    path = late_path(root, kind, name)
    if not sinks.exists(spark, path):
        return spark.createDataFrame([], _LATE)
    rows = spark.read.schema(_LATE).parquet(path)
    done = f"{path}-absorbed"
    if absorbed or not sinks.exists(spark, done):
        return rows
    return rows.join(spark.read.schema("batch BIGINT").parquet(done), "batch", "left_anti").select("timestamp", "series_id", "value", "batch")


def absorb_late(spark: SparkSession, root: str, rules: C.Rules, name: str = "readings") -> DataFrame:
    """Merge late rows that are not merged yet into the parts; returns the changed days.

    Each batch's late rows are a delivery of their own, so a run that breaks off before it
    is noted is repeated without counting anything twice.
    """
    rows = materialise(late_rows(spark, root, rules.kind, name, absorbed=False), "late")
    days = deliver(rows.withColumn("delivery", F.concat(F.lit(f"{name}-late-"), F.col("batch"))).drop("batch"), root, rules)
    rows.select("batch").distinct().coalesce(1).write.mode("append").parquet(f"{late_path(root, rules.kind, name)}-absorbed")
    return days
