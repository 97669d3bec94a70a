"""Joins that never need a hint to be correct.

Adaptive execution splits a hot key of an inner, semi, anti or one-sided outer join, but
not of a full outer join; for that case ``merge`` has a form made of the other kinds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lithosense.session import materialise


def _suffix(left: DataFrame, right: DataFrame, keys: list[str], suffixes: tuple[str, str]):
    """Rename columns both sides have (other than keys)."""
    both = [c for c in left.columns if c in set(right.columns) and c not in keys]
    return (
        left.withColumnsRenamed({c: c + suffixes[0] for c in both}),
        right.withColumnsRenamed({c: c + suffixes[1] for c in both}),
    )


def merge(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    suffixes: tuple[str, str] = ("_x", "_y"),
    null_safe: bool = False,
    hot_keys: bool = False,
) -> DataFrame:
    """Equi-join on shared key names; colliding columns get suffixes.

    ``null_safe=True`` lets NULL keys match each other.  ``how``: inner, left, outer.
    An outer join is one full join; with ``hot_keys`` it is made of parts whose hot keys
    can be split, for inputs where one key holds many rows on both sides.
    """
    left, right = _suffix(left, right, on, suffixes)
    if how == "outer" and hot_keys:
        return _outer(left, right, on, null_safe)
    if how == "outer" and null_safe:
        renamed = right.withColumnsRenamed({k: f"__{k}" for k in on})
        cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in on])
        both = left.join(renamed, cond, "full").withColumns({k: F.coalesce(F.col(k), F.col(f"__{k}")) for k in on})
        return both.select(*on, *[c for c in left.columns if c not in on], *[c for c in right.columns if c not in on])
    if how == "outer":
        return left.join(right, on, "full")
    if not null_safe:
        return left.join(right, on, how)
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in on})
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in on])
    return left.join(renamed, cond, how).drop(*[f"__{k}" for k in on])


def _outer(left: DataFrame, right: DataFrame, on: list[str], null_safe: bool) -> DataFrame:
    """Full outer join as inner ∪ left-only ∪ right-only.

    The two anti joins probe distinct keys (combined map-side), so no part has an
    unsplittable hot key; rows whose key is NULL never enter a shuffle unless
    NULLs are to match.
    """
    columns = on + [c for c in left.columns if c not in on] + [c for c in right.columns if c not in on]
    inner = merge(left, right, on, "inner", null_safe=null_safe).select(*columns)
    parts = [inner]
    for side, other in ((left, right), (right, left)):
        keys = other.select(*on).distinct()
        if null_safe:
            renamed = keys.withColumnsRenamed({k: f"__{k}" for k in on})
            cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in on])
            parts.append(side.join(renamed, cond, "left_anti"))
        else:
            missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
            parts.append(side.where(~missing).join(keys, on, "left_anti"))
            parts.append(side.where(missing))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select(*columns)


def semi_dates(weather: DataFrame, complete: DataFrame, keys: list[str]) -> DataFrame:
    """Rows on the dates/series found complete."""
    return weather.join(complete.select(*keys), keys, "left_semi")


def anti_existing(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not stored yet; NULL keys equal each other."""
    stored = existing.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    return new.join(stored, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]), "left_anti")


def join_dim(fact: DataFrame, dim: DataFrame, key: str = "series_id", dim_key: str = "sensor_id") -> DataFrame:
    """Fact ⋈ dimension.  Left to size-based broadcast selection."""
    return fact.join(dim.withColumnRenamed(dim_key, key) if dim_key != key else dim, key)


def join_on_day(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str) -> DataFrame:
    """Inner join of rows on the same day.  The day is a derived column on both
    sides, so it is an equi-join.  Many-to-many by definition; reports should
    aggregate each side per day first (see plans.views.daily_sensor_vs_weather)."""
    a = left.withColumn("day", F.col(left_ts).cast("date"))
    b = right.withColumn("day", F.col(right_ts).cast("date"))
    return a.join(b, "day")


def group_mean_fallback(rows: DataFrame, reference: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Fill NULLs with the mean of the same key in ``reference``.

    The means are written, so the join knows their size: few keys are broadcast, and a key
    with half of all rows does not bring them to one task.
    """
    means = materialise(reference.groupBy(key).agg(*[F.avg(c).alias(f"__{c}") for c in columns]), "group-means")
    filled: dict[str, Column] = {c: F.coalesce(F.col(c).cast("double"), F.col(f"__{c}")) for c in columns}
    return rows.join(means, key, "left").withColumns(filled).select(*rows.columns)
