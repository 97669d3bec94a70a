"""Reports over roll-ups and tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lithosense.constants import LAYERS


def weekly_summary(weekly: DataFrame) -> DataFrame:
    return weekly.groupBy("week_start").agg(
        F.avg("mean").alias("avg_mean"),
        F.avg("min").alias("avg_min"),
        F.avg("max").alias("avg_max"),
        F.avg("temp_range").alias("avg_range"),
        F.sum("count").alias("total_readings"),
    )


def layer_stats(weekly: DataFrame, dim: DataFrame) -> DataFrame:
    """Mean of mean, min, max per week and layer; sensors without a layer are skipped."""
    side = dim.select(F.col("sensor_id").alias("series_id"), "layer").where(F.col("layer").isNotNull())
    return weekly.join(side, "series_id").groupBy("week_start", "layer").agg(
        F.avg("mean").alias("mean"), F.avg("min").alias("min"), F.avg("max").alias("max")
    )


def null_counts(df: DataFrame) -> DataFrame:
    """(column, missing) for every column, in one pass."""
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return row.unpivot([], df.columns, "column", "missing")


def group_mean(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every column pair on rows where both are present.

    All pairs come from one pass: a task gives its rows, means and centred products of each
    pair, and these merge around the common mean.  Long form (a, b, r).
    """
    pairs = list(combinations(range(len(columns)), 2))
    kinds = ("n", "x", "y", "xx", "yy", "xy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for start in range(0, batch.num_rows, 8192):
                held = _merged(held, _moments(batch.slice(start, 8192)))
        if held is not None:
            first, second = (np.array([p[k] for p in pairs], np.intp) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(first, pa.int32()), pa.array(second, pa.int32()), *(pa.array(m[first, second]) for m in held)], names=["i", "j", *kinds])

    rows = df.select(*[F.col(c).cast("double").alias(f"_{k}") for k, c in enumerate(columns)])
    parts = rows.mapInArrow(run, "i int, j int, " + ", ".join(f"{k} double" for k in kinds)).groupBy("i", "j").agg(F.collect_list(F.struct(*kinds)).alias("p"))  # one a task
    total = lambda term: F.aggregate("p", F.lit(0.0), lambda acc, q: acc + F.when(q["n"] > 0, term(q)).otherwise(0.0))
    n = total(lambda q: q["n"])
    mean = lambda k: total(lambda q: q["n"] * q[k]) / F.nullif(n, F.lit(0.0))
    centred = parts.withColumns({"n": n, "mx": mean("x"), "my": mean("y")})
    of = lambda k, a, b: total(lambda q: q[k] + q["n"] * (q[a] - F.col(f"m{a}")) * (q[b] - F.col(f"m{b}")))
    r = of("xy", "x", "y") / F.nullif(F.sqrt(of("xx", "x", "x") * of("yy", "y", "y")), F.lit(0.0))
    found = centred.select("i", "j", r.alias("r"))
    names = F.array(*[F.lit(c) for c in columns])
    wanted = df.sparkSession.createDataFrame(pairs, "i INT, j INT")
    return wanted.join(found, ["i", "j"], "left").select(F.get(names, "i").alias("a"), F.get(names, "j").alias("b"), "r")


def _moments(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Rows, means and centred products of every two columns, over the rows that have both."""
    shown = np.array([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]).T.astype(float)
    values = np.array([c.fill_null(0.0).to_numpy() for c in batch.columns]).T
    bad = ~np.isfinite(values)
    x = np.where(bad, 0.0, values)
    low, high = (f(x, axis=0, where=shown > 0, initial=e) for f, e in ((np.min, np.inf), (np.max, -np.inf)))
    shift = np.where(low >= high, np.where(shown.any(axis=0), low, 0.0), x.sum(axis=0) / np.maximum(shown.sum(axis=0), 1))  # exact for a constant
    x = (x - shift) * shown
    n = shown.T @ shown
    each = np.maximum(n, 1)
    sx, sy = x.T @ shown, shown.T @ x
    square = (x * x).T @ shown
    xx, yy = square - sx * sx / each, square.T - sy * sy / each
    xy = x.T @ x - sx * sy / each
    if bad.any():  # NaN or infinite: no correlation is defined
        spoilt = (bad.astype(float).T @ shown + shown.T @ bad.astype(float)) > 0
        xy = np.where(spoilt, np.nan, xy)
    return [n, sx / each + shift[:, None], sy / each + shift[None, :], np.maximum(xx, 0), np.maximum(yy, 0), xy]


def _merged(a: list[np.ndarray] | None, b: list[np.ndarray]) -> list[np.ndarray]:
    if a is None:
        return b
    n = a[0] + b[0]
    each = np.maximum(n, 1)
    dx, dy, w = b[1] - a[1], b[2] - a[2], a[0] * b[0] / each
    share = b[0] / each
    return [n, a[1] + dx * share, a[2] + dy * share, a[3] + b[3] + dx * dx * w, a[4] + b[4] + dy * dy * w, a[5] + b[5] + dx * dy * w]


def pivot_layers(hourly: DataFrame, dim: DataFrame, layers: tuple[str, ...] = LAYERS) -> DataFrame:
    """Per instant, the highest mean of each layer as its own column."""
    side = dim.select(F.col("sensor_id").alias("series_id"), "layer")
    return (
        hourly.join(side, "series_id")
        .groupBy("timestamp")
        .agg(*[F.max(F.when(F.col("layer") == n, F.col("mean"))).alias(f"{n.lower()}_temp") for n in layers])
    )


def latest(df: DataFrame, ts: str = "timestamp") -> Column:
    """Newest instant as a scalar sub-query: usable in a filter that reaches the scan."""
    return df.agg(F.max(ts)).scalar()
