"""Order-dependent operators: change since the previous reading, latest reading,
first-wins de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lithosense.functions.times import bucket_start, seconds_between


def with_previous(
    df: DataFrame,
    series: str = "series_id",
    ts: str = "timestamp",
    carry: tuple[str, ...] = ("value",),
    tiebreak: tuple[str, ...] = (),
    slices: tuple[str, ...] = ("1 hour", "30 days"),
    out: str = "prev",
) -> DataFrame:
    """Add struct ``out`` = (ts, *carry) of the previous row of the same series.

    A plain ``lag`` over the series would sort all rows of one series in one
    task.  Here rows are windowed per (series, slice of time); the first row of a
    slice takes its predecessor from the last row of the nearest earlier slice
    that has data.  Those last rows form a much smaller table, to which the same
    method is applied with the next, wider slice.  The joins run on the
    partitioning the window already has.
    """
    order = [F.col(c) for c in (ts, *tiebreak)]
    payload = F.struct(F.col(ts), *[F.col(c) for c in carry])
    if not slices:
        return df.withColumn(out, F.lag(payload).over(Window.partitionBy(series).orderBy(*order)))

    depth = f"_slice{len(slices)}"
    sliced = df.withColumn(depth, bucket_start(ts, slices[0]))
    within = sliced.withColumn(
        out, F.lag(payload).over(Window.partitionBy(series, depth).orderBy(*order))
    )
    if tiebreak:
        last = sliced.groupBy(series, depth).agg(F.max_by(payload, F.struct(*order)).alias("_last"))
    else:  # primitive buffers only: stays a hash aggregation
        last = sliced.groupBy(series, depth).agg(
            F.max(ts).alias("_t"), *[F.max_by(c, ts).alias(f"_c_{c}") for c in carry]
        ).select(series, depth, F.struct(F.col("_t").alias(ts), *[F.col(f"_c_{c}").alias(c) for c in carry]).alias("_last"))
    carried = with_previous(last, series, depth, ("_last",), (), slices[1:], "_before").select(
        series, depth, F.col("_before._last").alias("_carried")
    )
    return (
        within.join(carried, [series, depth], "left")
        .withColumn(out, F.coalesce(F.col(out), F.col("_carried")))
        .drop(depth, "_carried")
        .select(*df.columns, out)
    )


def dense_index(
    df: DataFrame, series: list[str], ts: str, tiebreak: tuple[str, ...] = (), slice_: str = "1 hour", out: str = "idx"
) -> DataFrame:
    """Add ``out`` = 0, 1, 2, … per series in time order.

    Rows are numbered within (series, slice of time); a running count over the
    slices, one row each, gives every slice its offset.  No task sorts a whole series.
    """
    sliced = df.withColumn("_slice", bucket_start(ts, slice_))
    before = Window.partitionBy(*series).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*series, "_slice").agg(F.count(F.lit(1)).alias("_n"))
        .select(*series, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    local = F.row_number().over(Window.partitionBy(*series, "_slice").orderBy(ts, *tiebreak))
    return (
        sliced.withColumn("_local", local)
        .join(offsets, [*series, "_slice"])
        .select(*df.columns, (F.col("_offset") + F.col("_local") - 1).cast("bigint").alias(out))
    )


def rate_of_change(
    readings: DataFrame,
    series: str = "series_id",
    tiebreak: tuple[str, ...] = (),
    slices: tuple[str, ...] = ("1 hour", "30 days"),
) -> DataFrame:
    """Change, seconds and hourly rate since the previous reading of the series."""
    prev = with_previous(readings, series, tiebreak=tiebreak, slices=slices)
    change = F.col("value") - F.col("prev.value")
    seconds = seconds_between(F.col("prev.timestamp"), F.col("timestamp"))
    return prev.select(
        *readings.columns,
        change.alias("temp_change"),
        seconds.alias("seconds_diff"),
        (change / F.nullif(seconds, F.lit(0.0)) * 3600).alias("change_per_hour"),
    )


def latest_per_series(
    readings: DataFrame, keys: tuple[str, ...] = ("series_id",), tiebreak: tuple[str, ...] = ()
) -> DataFrame:
    """Latest value and instant per series: one aggregation, combined map-side."""
    if not tiebreak:
        return readings.groupBy(*keys).agg(
            F.max_by("value", "timestamp").alias("latest_value"), F.max("timestamp").alias("latest_timestamp")
        )
    order = F.struct("timestamp", *tiebreak)
    return readings.groupBy(*keys).agg(
        F.max_by("value", order).alias("latest_value"), F.max("timestamp").alias("latest_timestamp")
    )


def dedup_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    ``min_by`` keeps one candidate per key and task before the shuffle, so many
    copies of one key never meet in one reducer (a ``row_number`` would sort them
    all there).  ``order`` should be total.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*cols)).alias("_row"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def dedup_rows(df: DataFrame) -> DataFrame:
    """Whole-row duplicates removed (NULLs compare equal)."""
    return df.dropDuplicates()
