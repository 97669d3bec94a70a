"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lithosense.constants import RATIO_EPSILON


def to_double(c: Column | str) -> Column:
    """Number or NULL: text that does not parse, and NaN, both become NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))


def clip(c: Column, low: Column, high: Column) -> Column:
    """Bound to [low, high]; NULL stays NULL."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, low), high))


def safe_ratio(num: Column, den: Column) -> Column:
    return num / (den + F.lit(RATIO_EPSILON))


def log1p(c: Column) -> Column:
    """log(1+x); minus infinity at -1 and NaN below, as floating-point libraries define it."""
    x = c.cast("double")
    return (
        F.when(x > -1.0, F.log1p(x))
        .when(x == -1.0, F.lit(float("-inf")))
        .when(x < -1.0, F.lit(float("nan")))
    )


def midpoints(edges: Column) -> Column:
    """Array of n+1 bin edges to n midpoints."""
    n = F.size(edges) - 1
    return F.zip_with(F.slice(edges, 1, n), F.slice(edges, 2, n), lambda a, b: (a + b) / 2)


def value_range(high: str = "max", low: str = "min") -> Column:
    return F.col(high) - F.col(low)
