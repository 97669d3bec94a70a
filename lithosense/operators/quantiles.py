"""Exact quantiles and modes that hold at any size.

Spark's exact ``percentile`` keeps every distinct value of a group in one task.
Here it only ever sees a bracket of at most ``limit`` rows: brackets are narrowed
around each wanted rank by mergeable sketches, and every narrowing is verified by
exact counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from lithosense.session import materialise

_ACCURACY = 5_000


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], limit: int = 1_000_000) -> dict[str, list[float | None]]:
    """{column: [quantile, ...]} with linear interpolation, NULLs ignored.

    The columns are written once, so what lies behind ``df`` runs once.  Brackets are
    narrowed until they hold at most ``limit`` values or the wanted ones are known; each
    round is two passes over the written columns and shrinks a bracket about a thousandfold.
    Only a handful of numbers per (column, probability) reach the driver.
    """
    df = materialise(df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns]), "quantiles")
    num = {c: F.col(f"`{c}`") for c in columns}
    head = df.agg(
        *[f(v).alias(f"{k}{i}") for i, v in enumerate(num.values()) for k, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]
    ).first()
    targets = []
    for i, c in enumerate(columns):
        n = head[f"n{i}"]
        for j, p in enumerate(probs):
            rank = p * (n - 1) if n else 0.0
            targets.append(
                {"col": c, "j": j, "rank": rank, "below": 0, "m": n, "lo": head[f"lo{i}"], "hi": head[f"hi{i}"]}
            )
    while wide := [t for t in targets if t["m"] > limit and t["lo"] != t["hi"] and "value" not in t]:
        _narrow(df, num, wide)
    final = [t for t in targets if t["m"] and "value" not in t]
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in columns}
    for t in targets:
        if "value" in t:
            out[t["col"]][t["j"]] = t["value"]
    if final:
        # Targets that share a bracket share one percentile (one buffer).
        groups: dict[tuple, list[dict]] = {}
        for t in final:
            groups.setdefault((t["col"], t["lo"], t["hi"]), []).append(t)
        aggs = []
        for k, ts in enumerate(groups.values()):
            at = [min(1.0, max(0.0, (t["rank"] - t["below"]) / max(1, t["m"] - 1))) for t in ts]
            aggs.append(F.percentile(_inside(num[ts[0]["col"]], ts[0]), F.array(*[F.lit(p) for p in at])).alias(f"q{k}"))
        row = df.agg(*aggs).first()
        for k, ts in enumerate(groups.values()):
            for t, q in zip(ts, row[f"q{k}"]):
                out[t["col"]][t["j"]] = q
    return out


def _inside(v: Column, t: dict) -> Column:
    return F.when((v >= t["lo"]) & (v <= t["hi"]), v)


def _narrow(df: DataFrame, num: dict[str, Column], targets: list[dict]) -> None:
    """Shrink each target's bracket [lo, hi]; the ranks it needs stay inside."""
    guesses = []
    for k, t in enumerate(targets):
        p = (t["rank"] - t["below"]) / (t["m"] - 1)
        near = [max(0.0, p - 3 / _ACCURACY), min(1.0, p + 3 / _ACCURACY)]
        guesses.append(F.percentile_approx(_inside(num[t["col"]], t), near, _ACCURACY).alias(f"g{k}"))
    found = df.agg(*guesses).first()
    checks = []
    for k, t in enumerate(targets):
        v = num[t["col"]]
        a, b = found[f"g{k}"]
        t["try"] = (max(a, t["lo"]), min(b, t["hi"]))
        a, b = t["try"]
        checks += [
            F.count_if(v < a).alias(f"lt{k}"), F.count_if(v == a).alias(f"eqa{k}"),
            F.count_if(v <= b).alias(f"le{k}"), F.count_if(v == b).alias(f"eqb{k}"),
            F.min(F.when(v > a, v)).alias(f"next{k}"), F.max(F.when(v < b, v)).alias(f"prev{k}"),
        ]
    c = df.agg(*checks).first()
    for k, t in enumerate(targets):
        first, last = math.floor(t["rank"]), math.ceil(t["rank"])
        before = (t["below"], t["m"])
        end = t["below"] + t["m"]  # ranks [below, end) are inside
        a, b = t.pop("try")
        if c[f"lt{k}"] <= first:
            t["lo"], t["below"] = a, c[f"lt{k}"]
            if c[f"lt{k}"] + c[f"eqa{k}"] <= first:  # past all copies of a
                t["lo"], t["below"] = c[f"next{k}"], c[f"lt{k}"] + c[f"eqa{k}"]
        if c[f"le{k}"] > last:
            t["hi"], end = b, c[f"le{k}"]
            if c[f"le{k}"] - c[f"eqb{k}"] > last:  # before all copies of b
                t["hi"], end = c[f"prev{k}"], c[f"le{k}"] - c[f"eqb{k}"]
        t["m"] = end - t["below"]
        if (t["below"], t["m"]) == before:
            # Nothing to cut off: the two wanted ranks lie in the copies of a and of b, which
            # are the bracket's ends, however many copies there are.
            at_a, at_b = first < c[f"lt{k}"] + c[f"eqa{k}"], last >= c[f"le{k}"] - c[f"eqb{k}"]
            if not (at_a and at_b):
                raise RuntimeError("a quantile bracket did not shrink")
            t["value"] = a + (t["rank"] - first) * (b - a)


def percentiles(df: DataFrame, columns: list[str], probs: list[float], limit: int = 1_000_000) -> DataFrame:
    """(column, p, value) rows of exact quantiles."""
    found = exact_quantiles(df, columns, probs, limit)
    rows = [(c, float(p), v) for c in columns for p, v in zip(probs, found[c])]
    return df.sparkSession.createDataFrame(rows, "column STRING, p DOUBLE, value DOUBLE")


def describe(df: DataFrame, column: str, limit: int = 1_000_000) -> DataFrame:
    """count, mean, std, min, quartiles, max of one column."""
    q = exact_quantiles(df, [column], [0.25, 0.5, 0.75], limit)[column]
    v = F.col(column).cast("double")
    return df.agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
        *[F.lit(x).cast("double").alias(n) for n, x in zip(("p25", "p50", "p75"), q)],
        F.max(v).alias("max"),
    )


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, mode) of text columns: most frequent value, smallest on ties.

    Counts are combined map-side; no task holds all distinct values of a column.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "v")
    counts = long.where(F.col("v").isNotNull()).groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(F.min_by("v", F.struct(-F.col("n"), "v")).alias("mode"))


def group_quantiles(df: DataFrame, by: list[str], column: str, probabilities: list[float], names: list[str] | None = None) -> DataFrame:
    """Exact interpolated quantiles of every group: ``by``, ``n`` and one column a probability.

    Equal values are counted map-side; the distinct ones are sorted by range over all groups
    together, so a group of any size is spread over tasks.  Counts of the ranges before give
    every value its places, and the two values around a quantile's place are picked out.
    Nulls and NaN take no part; a group without values is absent.
    """
    names = names or [f"p{round(p * 100)}" for p in probabilities]
    value = F.col(column).cast("double")
    counted = df.select(*by, value.alias("_v")).where("_v IS NOT NULL AND NOT isnan(_v)").groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c"))
    ordered = counted.repartitionByRange(*by, "_v").sortWithinPartitions(*by, "_v").withColumn("_part", F.spark_partition_id())
    ordered = materialise(ordered, "ordered")
    pieces = ordered.groupBy(*by, "_part").agg(F.sum("_c").alias("_m"))
    group = Window.partitionBy(*by)
    before = F.coalesce(F.sum("_m").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = pieces.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], F.col("_part").alias("_q"), before.alias("_before"), F.sum("_m").over(group).alias("_n"))
    same = F.col("_part") == F.col("_q")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    within = F.sum("_c").over(Window.partitionBy(*by, "_part").orderBy("_v"))
    placed = ordered.withColumn("_within", within).join(pieces, same)
    upto = F.col("_before") + F.col("_within")

    def at(place):
        return F.max(F.when((upto > place) & (upto - F.col("_c") <= place), F.col("_v")))

    ends = []
    for i, p in enumerate(probabilities):
        place = (F.col("_n") - 1) * F.lit(float(p))
        ends += [at(F.floor(place)).alias(f"_lo{i}"), at(F.ceil(place)).alias(f"_hi{i}")]
    found = placed.groupBy(*by).agg(F.max("_n").alias("n"), *ends)
    out = []
    for i, (p, name) in enumerate(zip(probabilities, names)):
        place = (F.col("n") - 1) * F.lit(float(p))
        out.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (place - F.floor(place))).alias(name))
    return found.select(*by, "n", *out)
