"""Writers.  All are safe to repeat: a re-run replaces what it wrote before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lithosense import schema as S
from lithosense.operators.joins import anti_existing
from lithosense.operators.rollup import savable
from lithosense.session import materialise


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path holds anything, through the cluster's own file system layer."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_rollup(df: DataFrame, root: str, level: str, kind: str = "temperature", threshold: float = 0.001) -> str:
    """Store one level, valid rows only, partitioned by day (by week for weeks).

    Only the day partitions present in ``df`` are replaced (dynamic overwrite), so
    running a day again gives the same table, not duplicates.  Rows are grouped by
    day before the write, one to a few files per day, sorted so that row groups of
    a file can be skipped by series and time.
    """
    path = f"{root}/kind={kind}/level={level}"
    axis = S.AXIS[level]
    rows = savable(df, kind, threshold).withColumn("day", F.col(axis).cast("date"))
    (
        rows.hint("rebalance", "day")
        .sortWithinPartitions("day", "series_id", axis)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )
    return path


def one_per_key(df: DataFrame, keys: list[str], order: list[str] | None = None, last: bool = True) -> DataFrame:
    """One row per key (NULL keys equal each other): the last by ``order``, or the first.

    Without ``order`` the place in the input decides, so ``df`` should then be a table.
    """
    rows = df.withColumn("_place", F.struct(*order) if order else F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()))
    pick = (F.max_by if last else F.min_by)(F.struct(*df.columns), F.col("_place"))
    return rows.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(pick.alias("_row")).select("_row.*")


def append_new_only(new: DataFrame, path: str, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Append rows whose key is not stored yet (stored rows win, then the first new one); returns them.

    A second call with the same rows adds nothing.
    """
    spark = new.sparkSession
    fresh = one_per_key(materialise(new, "append-new"), keys, order, last=False)
    if exists(spark, path):
        fresh = anti_existing(fresh, spark.read.schema(new.schema).parquet(path), keys)
    # Written aside first: the rows are decided before the target changes.
    fresh = materialise(fresh, "append")
    fresh.write.mode("append").parquet(path)
    return fresh


def merged(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows after an upsert: new rows replace stored ones with the same key (NULL keys equal each other)."""
    return anti_existing(existing, new, keys).unionByName(new)


def upsert(new: DataFrame, path: str, keys: list[str], partition: str, order: list[str] | None = None) -> None:
    """Insert-or-replace by key, rewriting only the partitions ``new`` touches.

    ``partition`` is one of the keys and the table's partition column.  Of several new rows
    with one key the last by ``order`` (else by place in the input) counts.  Stored rows are
    read by a semi-join on the touched partition values, which prunes partitions at run
    time.  The rows to be written are staged whole before the target changes: a run that
    breaks off while the target is overwritten is repaired by running it again.
    """
    spark = new.sparkSession
    new = materialise(one_per_key(materialise(new, "upsert-in"), keys, order), "upsert-new")
    rows = new
    if exists(spark, path):
        stored = spark.read.parquet(path).select(*new.columns)
        touched = new.select(partition).distinct()
        kept = stored.join(touched, partition, "left_semi").select(*new.columns)
        if not touched.where(F.col(partition).isNull()).isEmpty():
            kept = kept.unionByName(stored.where(F.col(partition).isNull()))
        rows = materialise(merged(kept, new, keys), "upsert")  # a table cannot be read while it is overwritten
    (
        rows.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def seed_dimension(seed: DataFrame, path: str, key: str = "sensor_id") -> DataFrame:
    """Insert dimension rows whose key is not there yet; returns the inserted rows."""
    return append_new_only(seed, path, [key])


def export_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    writer = df.write.mode("overwrite")
    (writer.option("header", True).csv if fmt == "csv" else writer.parquet)(path)
    return path


def archive_due(last_update: str | None, as_of: str, days: int = 7) -> bool:
    """The weekly rule: first run, or at least ``days`` since the last update."""
    from datetime import datetime

    if last_update is None:
        return True
    return (datetime.fromisoformat(as_of) - datetime.fromisoformat(last_update)).days >= days


def archive_week(spark: SparkSession, root: str, archive_root: str, level: str, kind: str, week_start: str) -> DataFrame:
    """Move one closed week of a level out of the current table; returns its manifest.

    The copy is written, read back and counted against the source; only if both agree is
    the manifest stored (``<archive_root>/manifest``) and are the source's days dropped.  A
    second run finds nothing left to move and returns the stored manifest; a week without
    rows has an empty one.
    """
    path = f"{root}/kind={kind}/level={level}"
    target = f"{archive_root}/kind={kind}/level={level}/week_start={week_start}"
    record = f"{archive_root}/manifest/kind={kind}/level={level}/week_start={week_start}"
    first = F.to_date(F.lit(week_start))
    stored = S.ARCHIVE_INFO
    days: list = []
    if exists(spark, path):
        week = spark.read.schema(S.ROLLUP[level] + ", day DATE").parquet(path).where(F.col("day").between(first, F.date_add(first, 6)))
        counted = {r["day"]: r["count"] for r in week.groupBy("day").count().collect()}  # at most 7 values
        days = list(counted)
    if days:
        week.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(target)
        copy = spark.read.schema(S.ROLLUP[level] + ", day DATE").parquet(target)
        copied = {r["day"]: r["count"] for r in copy.groupBy("day").count().collect()}
        if any(copied.get(day) != n for day, n in counted.items()):
            raise RuntimeError(f"the copy of week {week_start} does not hold the rows of {path}; nothing was deleted")
        files = copy.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).groupBy("file").agg(
            F.max("size").alias("size"), F.count(F.lit(1)).alias("rows")
        )
        files.agg(F.sum("size").alias("file_size"), F.sum("rows").alias("rows")).select(
            first.alias("interval_start"),
            F.date_add(first, 6).alias("interval_end"),
            F.lit(target).alias("path"),
            F.col("file_size").cast("bigint"),
            F.col("rows").cast("bigint"),
            F.lit("COMPLETED").alias("status"),
        ).coalesce(1).write.mode("overwrite").parquet(record)
        for day in days:
            delete_path(spark, f"{path}/day={day.isoformat()}")
    return spark.read.schema(stored).parquet(record) if exists(spark, record) else spark.createDataFrame([], stored)
