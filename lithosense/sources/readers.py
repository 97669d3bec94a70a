"""Readers.  Every reader scans a path or glob; CSV files are first grouped by their header."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lithosense import schema as S
from lithosense.operators.ingest import (
    coerce_numeric,
    drop_null_ts,
    resolve_ts_columns,
    resolve_weather_ts,
)
from lithosense.operators.windows import dedup_first

# Position of a row in the input: file, split within it, row within the split.
FILE, BLOCK, ROW = "_file", "_block", "_row"
POSITION = [FILE, BLOCK, ROW]


def with_position(df: DataFrame) -> DataFrame:
    """Add the input position, so that 'first' is defined after any shuffle."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(ROW),
    )


def scan_channels(spark: SparkSession, samples: str, meta: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Decoded channels: (samples, meta).  Where the meta table lacks a modification
    time, the storage layer's is used."""
    read = spark.read.schema(S.CHANNEL_SAMPLE)
    data = read.option("header", True).csv(samples) if fmt == "csv" else read.parquet(samples)
    facts = spark.read.schema(S.CHANNEL_META).parquet(meta)
    facts = facts.withColumn("modified", F.coalesce("modified", F.col("_metadata.file_modification_time")))
    return data, facts


def file_heads(spark: SparkSession, path: str) -> DataFrame:
    """(file, head): the first line of every text file.

    Lines stream by twice, first for the least place in each file, then for the line there; no task
    holds or sorts them.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value", F.monotonically_increasing_id().alias("row")
    )
    first = lines.where("block = 0").groupBy("file").agg(F.min("row").alias("row"))
    return lines.where("block = 0").join(F.broadcast(first), ["file", "row"]).select("file", F.col("value").alias("head"))


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV files as text columns, matched by name: a file may lack columns or have them in another order.

    Spark gives all files of one read the first file's header.  So a first pass takes every
    file's header line; files with one header are read together, and the groups are united
    by name.  Rows keep their file and place (``_file, _block, _row``).
    """
    layouts = file_heads(spark, path).groupBy("head").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("head").collect()
    parts = [with_position(spark.read.option("header", True).csv(row["files"])) for row in layouts]
    if not parts:
        return with_position(spark.read.option("header", True).csv(path))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def scan_readings_wide(spark: SparkSession, path: str, fmt: str = "csv", start: str | None = None) -> DataFrame:
    """Wide sensor export with a resolved ``timestamp``.  CSV columns are read as
    text (header only, no inference pass) and typed where used."""
    df = scan_csv(spark, path).drop(*POSITION) if fmt == "csv" else spark.read.parquet(path)
    return resolve_ts_columns(df, start)


def scan_weather(spark: SparkSession, path: str) -> DataFrame:
    """Station records: text in, timestamp resolved, numbers typed, bad stamps dropped
    (use ``operators.filters.quarantine`` on ``resolve_weather_ts`` to keep them)."""
    raw = scan_csv(spark, path).drop(*POSITION)
    return coerce_numeric(drop_null_ts(resolve_weather_ts(raw)))


def scan_weather_dir(spark: SparkSession, path: str) -> DataFrame:
    """All station CSVs of a folder, columns by name, first record per instant in file order."""
    raw = scan_csv(spark, f"{path}/*.csv")
    typed = drop_null_ts(resolve_weather_ts(raw))
    unique = dedup_first(typed, ["timestamp"], POSITION).drop(*POSITION)
    return coerce_numeric(unique)


def scan_rollup(spark: SparkSession, root: str, level: str, kind: str = "temperature", skip_corrupt: bool = False, dedup: bool = True, days: tuple[str, str] | None = None, where: Column | None = None) -> DataFrame:
    """A stored level, first row per (time, series) in file order.

    ``days`` (first, last) reads only those day partitions, ``where`` those with its condition on ``day``.  A damaged file is an error
    unless ``skip_corrupt``.  Layout is ``kind=/level=/day=``: filters on kind and level never list the
    rest, filters on ``day`` prune partitions.
    """
    path = f"{root}/kind={kind}/level={level}"
    df = (
        spark.read.schema(S.ROLLUP[level] + ", day DATE")
        .option("ignoreCorruptFiles", skip_corrupt)
        .parquet(path)
    )
    if days:
        df = df.where(F.col("day").between(F.to_date(F.lit(days[0])), F.to_date(F.lit(days[1]))))
    if where is not None:
        df = df.where(where)
    if not dedup:  # tables kept by write_rollup hold each key once
        return df.drop("day")
    return dedup_first(with_position(df), [S.AXIS[level], "series_id"], POSITION).drop("day", *POSITION)


def scan_rollup_csv(spark: SparkSession, folder: str, level: str, kind: str = "temperature", series: str = "sensor_id") -> DataFrame:
    """Statistics files ``{kind}_{level}_*.csv`` as earlier tools wrote them."""
    raw = scan_csv(spark, f"{folder}/{kind}_{level}_*.csv")
    axis = S.AXIS[level]
    axis_type = "timestamp_ntz" if axis == "timestamp" else "date"
    first = dedup_first(raw, [axis, series], POSITION).drop(*POSITION)
    days = [c for c in ("week_end",) if c in raw.columns]
    numbers = [c for c in ("mean", "min", "max", "std", "temp_range") if c in raw.columns]
    typed = coerce_numeric(first, numbers)
    return (
        typed.withColumn(axis, F.try_to_timestamp(F.col(axis)).cast(axis_type))
        .withColumns({c: F.to_date(F.try_to_timestamp(F.col(c))) for c in days})
        .withColumn("count", F.col("count").try_cast("double").cast("bigint"))
        .withColumnRenamed(series, "series_id")
    )


def scan_section_tables(spark: SparkSession, root: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """The annual survey tables, explicit schemas, one folder or file per table."""
    out = {}
    for name, ddl in S.SECTION_TABLES.items():
        if fmt == "csv":
            raw = scan_csv(spark, f"{root}/{name}")
            fields = spark.createDataFrame([], ddl).schema
            out[name] = raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields])
        else:
            out[name] = spark.read.schema(ddl).parquet(f"{root}/{name}")
    return out
