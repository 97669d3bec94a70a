"""Metrics, ensemble weights, prediction tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lithosense.functions import stats


def metrics(df: DataFrame, label: str, prediction: str = "prediction", by: list[str] = ()) -> DataFrame:
    """R², MSE, MAE and rows, optionally per group: one aggregation."""
    return df.groupBy(*by).agg(
        stats.r2(label, prediction).alias("r2"),
        stats.mse(label, prediction).alias("mse"),
        stats.mae(label, prediction).alias("mae"),
        F.count(F.lit(1)).alias("n"),
    )


def weight_search(df: DataFrame, label: str, a: str, b: str, steps: int = 20) -> DataFrame:
    """(weight, r2) of w·a + (1−w)·b for w = 0, 1/steps, …, 1.

    The squared errors of all weights are summed in one pass over the rows; no row
    is repeated per weight.
    """
    y, pa, pb = (F.col(c).cast("double") for c in (label, a, b))
    sums = []
    for k in range(steps + 1):
        w = F.lit(k) / F.lit(float(steps))
        err = y - (w * pa + (1 - w) * pb)
        sums.append(F.avg(err * err).alias(f"m{k}"))
    row = df.agg(F.var_pop(y).alias("v"), *sums)
    entries = F.array(
        *[
            F.struct((F.lit(k) / F.lit(float(steps))).alias("weight"), (1 - F.col(f"m{k}") / F.nullif("v", F.lit(0.0))).alias("r2"))
            for k in range(steps + 1)
        ]
    )
    return row.select(F.inline(entries))


def best_weight(scores: DataFrame) -> DataFrame:
    """Highest R², the smallest weight on ties."""
    return scores.agg(F.min_by(F.struct("weight", "r2"), F.struct(-F.col("r2"), "weight")).alias("b")).select("b.*")


def blend(df: DataFrame, a: str, b: str, weight: float, out: str = "prediction") -> DataFrame:
    return df.withColumn(out, F.lit(weight) * F.col(a) + F.lit(1.0 - weight) * F.col(b))


def pred_vs_actual(parts: dict[str, DataFrame], label: str, prediction: str = "prediction") -> DataFrame:
    """(split, actual, predicted) of scored parts."""
    out = None
    for name, df in parts.items():
        rows = df.select(F.lit(name).alias("split"), F.col(label).cast("double").alias("actual"), F.col(prediction).alias("predicted"))
        out = rows if out is None else out.unionByName(rows)
    return out
