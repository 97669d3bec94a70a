"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _buckets(n: Column, mean: Column, std: Column) -> Column:
    """The finer buckets of a group as an array.

    A coarser bucket holds 4 quarters, 24 hours or 7 days, so the array is short; with all
    of it at hand the spread is taken around the group's own mean and nothing cancels.
    """
    return F.collect_list(F.struct(n.cast("double").alias("n"), mean.cast("double").alias("m"), std.cast("double").alias("s")))


def _sum(buckets: Column, term) -> Column:
    return F.aggregate(buckets, F.lit(0.0), lambda acc, x: acc + F.coalesce(term(x), F.lit(0.0)))


def pooled_std(
    n: Column | str = "count",
    mean: Column | str = "mean",
    std: Column | str = "std",
    null_std: str = "propagate",
) -> Column:
    """Pooled standard deviation of finer buckets: sqrt((Σn·s² + Σn·(m−M)²) / N).

    An aggregate for groups of few rows (the finer buckets of one coarser bucket).
    ``null_std`` says what a missing finer deviation does: ``propagate`` makes the result
    NULL, ``zero`` counts it as 0 and also gives 0 for a single reading.  For groups of any
    size use ``rollup.pooled_std_two_pass``.
    """
    if null_std not in ("propagate", "zero"):
        raise ValueError(f"null_std must be 'propagate' or 'zero', not {null_std!r}")
    rows = _buckets(_c(n), _c(mean), _c(std))
    total = _sum(rows, lambda x: x["n"])
    centre = _sum(rows, lambda x: x["n"] * x["m"]) / F.nullif(total, F.lit(0.0))

    def term(x: Column) -> Column:
        s = F.coalesce(x["s"], F.lit(0.0))
        return x["n"] * (s * s + (x["m"] - centre) * (x["m"] - centre))

    out = F.when(total == 0, F.lit(0.0)).otherwise(F.sqrt(_sum(rows, term) / F.nullif(total, F.lit(0.0))))
    if null_std == "propagate":
        return F.when(~F.exists(rows, lambda x: x["s"].isNull()), out)
    return F.when(total == 1, F.lit(0.0)).otherwise(out)


def weighted_mean(n: Column | str = "count", mean: Column | str = "mean") -> Column:
    n, mean = _c(n), _c(mean)
    return F.sum(n * mean) / F.nullif(F.sum(n), F.lit(0))


def exact_std(n: Column | str = "count", mean: Column | str = "mean", std: Column | str = "std") -> Column:
    """Sample standard deviation of the raw readings behind finer buckets, from
    their (count, mean, sample std); a missing std (one reading) adds nothing."""
    rows = _buckets(_c(n), _c(mean), _c(std))
    total = _sum(rows, lambda x: x["n"])
    centre = _sum(rows, lambda x: x["n"] * x["m"]) / F.nullif(total, F.lit(0.0))
    m2 = _sum(rows, lambda x: (x["n"] - 1) * F.coalesce(x["s"] * x["s"], F.lit(0.0)) + x["n"] * (x["m"] - centre) * (x["m"] - centre))
    return F.when(total > 1, F.sqrt(m2 / (total - 1)))


def mse(label: Column | str, prediction: Column | str) -> Column:
    err = _c(label) - _c(prediction)
    return F.avg(err * err)


def mae(label: Column | str, prediction: Column | str) -> Column:
    return F.avg(F.abs(_c(label) - _c(prediction)))


def r2(label: Column | str, prediction: Column | str) -> Column:
    """1 − SSE/SST, in one pass (var_pop merges stably)."""
    return 1 - mse(label, prediction) / F.nullif(F.var_pop(_c(label)), F.lit(0.0))
