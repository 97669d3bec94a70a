"""Stored levels brought up to date: only days that have changed are replaced.

Delivered readings of any age become parts of their 15-minute buckets and merge with what
earlier deliveries said about them (``plans.parts``), so a late reading adds to its bucket.
The days of parts that are new or differ are written again and noted for the next level,
which computes them (whole weeks by their Monday) beside the days since its own mark.
Buckets that have not ended by ``as_of`` are kept as parts and appear in a later run.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from lithosense import schema as S
from lithosense.constants import LEVELS
from lithosense.functions.times import week_of
from lithosense.operators import filters
from lithosense.plans import cascade as C, parts as P
from lithosense.session import materialise
from lithosense.sources import readers, sinks, state


def first_day(spark: SparkSession, root: str, level: str, kind: str, late_days: int) -> date | None:
    """The first day to compute again: the job's mark less the days that may bring late rows,
    moved back to the Monday where whole weeks are needed.  None when the job never ran."""
    job = state.read_state(spark, f"{root}/_state").where(F.col("status_type") == f"{kind}_{level}")
    mark = job.agg(F.max("last_processed").alias("m")).first()["m"]
    if mark is None:
        return None
    day = mark.date() - timedelta(days=late_days)
    return day - timedelta(days=day.weekday()) if level == "weekly" else day


def _noted_path(root: str, level: str, kind: str) -> str:
    return f"{root}/_changed/kind={kind}/level={level}"


def noted_days(spark: SparkSession, root: str, level: str, kind: str) -> list[date]:
    """Days of the finer level that were written since this level was last computed; a date a day at most."""
    path = _noted_path(root, level, kind)
    if not sinks.exists(spark, path):
        return []
    return [r["day"] for r in spark.read.schema("day DATE").parquet(path).distinct().orderBy("day").collect()]


def _note(days: DataFrame, root: str, level: str, kind: str, mode: str) -> None:
    days.coalesce(1).write.mode(mode).parquet(_noted_path(root, level, kind))


def stored_level(spark: SparkSession, root: str, level: str, kind: str) -> DataFrame | None:
    """A stored level with its ``day``, or None."""
    path = f"{root}/kind={kind}/level={level}"
    return spark.read.schema(S.ROLLUP[level] + ", day DATE").parquet(path) if sinks.exists(spark, path) else None


def deliver(readings: DataFrame, root: str, rules: C.Rules, full: bool = False, overlap: bool = False) -> DataFrame:
    """Merge readings into the stored parts and note the changed days for the 15-minute level; returns those days."""
    spark = readings.sparkSession
    if overlap:
        readings = P.unseen(readings, root, rules.kind)
    note = lambda days: _note(days, root, "15min", rules.kind, "append")
    return P.add(readings, root, rules, stored_level(spark, root, "15min", rules.kind), note, replace_days=full)


def update_level(
    spark: SparkSession, root: str, level: str, rules: C.Rules, readings: DataFrame | None = None,
    as_of: str | None = None, late_days: int = 1, full: bool = False, overlap: bool = False,
) -> DataFrame:
    """Compute one level from the finer one (``readings`` for 15 minutes), store it, move the mark.

    For 15 minutes all readings are merged with what is stored (without ``readings``, days
    that were delivered otherwise are brought up to date): a column ``delivery`` names
    the delivery of a reading (else the whole input is one, known by its content), and a
    delivery that comes again changes nothing.  ``overlap`` says that deliveries may repeat
    readings of others; of an (instant, series) the first delivery counts then.  Above, the
    finer level's day partitions from ``first_day`` on and those noted as changed are read;
    ``full`` reads all and replaces whole days.  A run can be repeated.  Returns the rows
    written.
    """
    start = None if full else first_day(spark, root, level, rules.kind, late_days)
    noted = noted_days(spark, root, level, rules.kind)
    if level == "15min":
        if readings is not None:
            deliver(readings, root, rules, full=full, overlap=overlap)
        noted = noted_days(spark, root, level, rules.kind)
        parts = P.read_parts(spark, root, rules.kind).where(F.col("day").isin(noted))
        rows = C.keep(P.merged(parts, rules), rules)
    else:
        day = week_of(F.col("day")) if level == "weekly" else F.col("day")
        again = sorted({d - timedelta(days=d.weekday()) for d in noted}) if level == "weekly" else noted
        days = None if start is None else (F.col("day") >= F.lit(start)) | day.isin(again)
        rows = C.level_of(readers.scan_rollup(spark, root, LEVELS[LEVELS.index(level) - 1], rules.kind, dedup=False, where=days), level, rules)
    if as_of:
        rows = filters.closed_buckets(rows, level, as_of)
    rows = materialise(rows, f"level-{level}")
    if level != LEVELS[-1]:
        # noted before the write, so that a run that breaks off leaves nothing unnoticed
        _note(rows.select(F.col(S.AXIS[level]).cast("date").alias("day")).distinct(), root, LEVELS[LEVELS.index(level) + 1], rules.kind, "append")
    sinks.write_rollup(rows, root, level, rules.kind, rules.threshold or 0.001)
    if noted:
        # days whose buckets have not ended by as_of wait for a later run
        last = date.fromisoformat(as_of[:10]) - timedelta(days=7 if level == "weekly" else 1) if as_of else date.max
        waiting = [(d,) for d in noted if (d - timedelta(days=d.weekday()) if level == "weekly" else d) > last]
        _note(spark.createDataFrame(waiting, "day DATE"), root, level, rules.kind, "overwrite")
    before = state.read_state(spark, f"{root}/_state").where(F.col("status_type") == f"{rules.kind}_{level}").select("last_processed")
    newest = rows.select(F.col(S.AXIS[level]).cast("timestamp_ntz").alias("last_processed")).unionByName(before)
    mark = newest.agg(F.max("last_processed").alias("last_processed")).where("last_processed IS NOT NULL").select(
        F.lit(f"{rules.kind}_{level}").alias("status_type"), F.lit(as_of).cast("timestamp_ntz").alias("last_run"),
        "last_processed", F.lit("SUCCESS").alias("status"), F.lit("").alias("message"),
    )
    state.update_state(spark, f"{root}/_state", mark)
    return rows
