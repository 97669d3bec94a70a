"""Last-processed marks per job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lithosense.constants import EPOCH_MARK
from lithosense.schema import PROCESSING_STATE
from lithosense.sources.sinks import exists, merged
from lithosense.session import materialise


def read_state(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], PROCESSING_STATE)
    return spark.read.schema(PROCESSING_STATE).parquet(path)


def last_mark(state: DataFrame, status_type: str) -> Column:
    """Scalar mark of one job, long ago when it never ran; use it in a filter."""
    newest = state.where(F.col("status_type") == status_type).agg(F.max("last_processed").alias("m"))
    return F.coalesce(newest.scalar(), F.lit(EPOCH_MARK).cast("timestamp_ntz"))


def processing_marks(processed: DataFrame, job: Column | str, ts: str = "timestamp") -> DataFrame:
    """(status_type, last_processed) of what a run handled, per job column."""
    return processed.groupBy((F.col(job) if isinstance(job, str) else job).alias("status_type")).agg(
        F.max(ts).alias("last_processed")
    )


def update_state(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Replace the rows of the given jobs.  One row per job: a tiny table."""
    staged = materialise(merged(read_state(spark, path), rows.select(*read_state(spark, path).columns), ["status_type"]), "state")
    staged.coalesce(1).write.mode("overwrite").parquet(path)
