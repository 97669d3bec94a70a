"""Tables laid out by sensor: bucketed by its id and sorted by time within a bucket.

Windows, joins and aggregations on that id read such a table bucket by bucket without moving
rows; two tables with the same buckets join in place.  A bucket is a file (a few after
appends), so the number of buckets is a property of the table: choose it for files of some
hundred megabytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_clustered(df: DataFrame, table: str, buckets: int, key: str = "series_id", order: tuple[str, ...] = ("timestamp",), path: str | None = None, mode: str = "overwrite") -> DataFrame:
    """Store ``df`` as ``table``, one file a bucket, and return the table.

    A key that holds most rows fills one bucket; cluster by (series, day) then, or leave the table in day partitions.
    """
    present = [c for c in order if c in df.columns]
    # the shuffle deals rows as the buckets do, so that every task writes one file
    writer = df.repartition(buckets, key).sortWithinPartitions(key, *present).write.mode(mode).bucketBy(buckets, key).sortBy(key, *present).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def drop_table(df: DataFrame, table: str) -> None:
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
