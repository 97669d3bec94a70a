"""Splits, imputation, outliers, scaling and feature columns."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import combinations, combinations_with_replacement

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from lithosense.constants import SEED
from lithosense.functions import numeric
from lithosense.operators.quantiles import exact_quantiles, modes
from lithosense.session import materialise

ROWS_PER_TASK = 500_000


# --- layout ----
def spread(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The rows written once and dealt evenly over tasks of at most ``rows_per_task``.

    Learners read their rows many times and keep them in memory as a task got them, so what
    lies behind ``df`` runs once, and the number of tasks follows the rows, not the bytes of files.
    """
    kept = materialise(df, "spread")
    tasks = math.ceil(kept.count() / rows_per_task)
    return kept.repartition(tasks) if tasks > 1 else kept


@contextmanager
def dealt(df: DataFrame) -> Iterator[DataFrame]:
    """``spread``, kept on the executors' disks for as long as several fits and scorings read it.

    Without that each of them would deal all rows anew.  A lost block is dealt again from the written table.
    """
    rows = spread(df).persist(StorageLevel.DISK_ONLY)
    try:
        yield rows
    finally:
        rows.unpersist()


# --- splits --------------------------------------------------------------------
def bucket_of(keys: list[str], buckets: int, seed: int = SEED) -> Column:
    """Stable bucket of a row by the hash of its key: the same on any cluster and
    any partitioning, unlike ``randomSplit``."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def digest_bucket(keys: list[str], buckets: int) -> Column:
    """A row's bucket by the MD5 of its key, a rule that other engines have too."""
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys])
    return (F.conv(F.left(F.md5(key.cast("binary")), F.lit(8)), 16, 10).cast("bigint") % buckets).cast("int")


def digest_split(df: DataFrame, keys: list[str], test: float = 0.2) -> DataFrame:
    """Tag rows ``train``/``test`` by the digest of their key."""
    return df.withColumn("split", F.when(digest_bucket(keys, 10_000) < round(test * 10_000), "test").otherwise("train"))


def held_by_hash(keys: list[str], test: float = 0.2, seed: int = SEED) -> Column:
    """Whether ``hash_split`` keeps a row for the test."""
    return bucket_of(keys, 10_000, seed) < round(test * 10_000)


def hash_split(df: DataFrame, keys: list[str], test: float = 0.2, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(train, test)."""
    held = held_by_hash(keys, test, seed)
    return df.where(~held), df.where(held)


def modulo_split(df: DataFrame, key: str, buckets: int = 10, train: int = 8) -> DataFrame:
    """Tag rows ``train``/``test`` by an integer key, a rule any engine can repeat."""
    return df.withColumn("split", F.when(F.col(key) % buckets < train, "train").otherwise("test"))


def train_val_test(df: DataFrame, keys: list[str], test: float = 0.2, seed: int = SEED):
    """80/20, then 80/20 of the training part for validation."""
    rest, held = hash_split(df, keys, test, seed)
    train, val = hash_split(rest, keys, test, seed + 1)
    return train, val, held


# --- imputation ----------------------------------------------------------------
def impute(df: DataFrame, numeric_cols: list[str], text_cols: list[str] = (), limit: int = 1_000_000) -> DataFrame:
    """Median for numbers, most frequent value for text (smallest on ties)."""
    fill = {c: q[0] for c, q in exact_quantiles(df, list(numeric_cols), [0.5], limit).items() if q[0] is not None}
    out = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in fill.items()})
    if text_cols:
        found = {r["column"]: r["mode"] for r in modes(df, list(text_cols)).collect()}  # one row per column
        out = out.na.fill({c: v for c, v in found.items() if v is not None})
    return out


def impute_mean(df: DataFrame, columns: list[str], fill_all_with_mean_of: str | None = None) -> DataFrame:
    """Mean per column; or one column's mean for every listed column (the source
    analysis does that, with the layer thickness)."""
    means = df.agg(*[F.avg(c).alias(c) for c in set(columns) | ({fill_all_with_mean_of} - {None})]).first()
    source = {c: means[fill_all_with_mean_of or c] for c in columns}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in source.items()})


# --- outliers --------------------------------------------------------------------
def outlier_bounds(df: DataFrame, column: str, threshold: float = 3.0) -> tuple[float, float]:
    """mean ± threshold · population deviation."""
    r = df.agg(F.avg(column).alias("m"), F.stddev_pop(column).alias("s")).first()
    return r["m"] - threshold * r["s"], r["m"] + threshold * r["s"]


def handle_outliers(df: DataFrame, column: str, method: str = "winsorize", threshold: float = 3.0) -> DataFrame:
    """``clip`` drops rows at or beyond ``threshold`` deviations, ``winsorize`` bounds
    the value, anything else leaves the data alone.  Statistics are one scalar
    sub-query, so this stays one lazy plan."""
    if method not in ("clip", "winsorize"):
        return df
    stats = df.agg(F.struct(F.avg(column).alias("m"), F.stddev_pop(column).alias("s")).alias("x")).scalar()
    c = F.col(column)
    if method == "clip":
        return df.where(F.abs((c - stats["m"]) / stats["s"]) < threshold)
    return df.withColumn(column, numeric.clip(c, stats["m"] - threshold * stats["s"], stats["m"] + threshold * stats["s"]))


# --- scaling ----------------------------------------------------------------------
def scale_robust(df: DataFrame, columns: list[str], limit: int = 1_000_000) -> DataFrame:
    """(x − median) / interquartile range, a zero range counting as 1."""
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75], limit)
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit((hi - lo) or 1.0) for c, (lo, m, hi) in q.items()})


def scale_standard(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x − mean) / population deviation, a zero deviation counting as 1."""
    stats = df.agg(
        F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]).alias("x")
    ).first()["x"]
    return df.withColumns({c: (F.col(c) - stats[c]["m"]) / F.lit(stats[c]["s"] or 1.0) for c in columns})


# --- feature columns -----------------------------------------------------------------
def domain_columns(temp_ratio=True, precip_kesal=True, res_mod_ratio=True, temp_precip=True) -> dict[str, Column]:
    c = lambda name: F.col(name).cast("double")
    all_ = {
        "TEMP_RATIO": (temp_ratio, numeric.safe_ratio(c("MAX_ANN_TEMP_DAYS"), c("MAX_ANN_TEMP_AVG"))),
        "PRECIP_KESAL": (precip_kesal, c("TOTAL_ANN_PRECIP") * c("ANL_KESAL_LTPP_LN_YR")),
        "RES_MOD_RATIO": (res_mod_ratio, numeric.safe_ratio(c("RES_MOD_AVG"), c("REPR_THICKNESS"))),
        "TEMP_PRECIP_PRODUCT": (temp_precip, c("MAX_ANN_TEMP_AVG") * c("TOTAL_ANN_PRECIP")),
    }
    return {name: expr for name, (on, expr) in all_.items() if on}


def domain_features(df: DataFrame, **toggles: bool) -> DataFrame:
    return df.withColumns(domain_columns(**toggles))


def log_features(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: numeric.log1p(F.col(c)) for c in columns})


def poly_columns(columns: list[str], degree: int, interaction_only: bool = False) -> dict[str, Column]:
    """Products of up to ``degree`` columns (no constant), named ``a*b``."""
    pick = combinations if interaction_only else combinations_with_replacement
    out = {}
    for d in range(1, degree + 1):
        for combo in pick(columns, d):
            expr = F.col(combo[0]).cast("double")
            for c in combo[1:]:
                expr = expr * F.col(c)
            out["*".join(combo)] = expr
    return out


def poly(df: DataFrame, columns: list[str], degree: int, interaction_only: bool = False) -> DataFrame:
    return df.select("*", *[e.alias(n) for n, e in poly_columns(columns, degree, interaction_only).items() if "*" in n])


def power_blocks(df: DataFrame, columns: list[str], degree: int = 2) -> DataFrame:
    """Powers 1..degree per column, no cross terms."""
    return df.withColumns({f"{c}^{d}": F.pow(F.col(c), F.lit(float(d))) for d in range(2, degree + 1) for c in columns})


class FeatureBuilder(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Domain columns, optional log, polynomial expansion, into one vector.

    Each choice is a Param, so a grid can switch it like any model setting.
    """

    inputCols = Param(Params._dummy(), "inputCols", "base feature columns", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)
    tempRatio = Param(Params._dummy(), "tempRatio", "add TEMP_RATIO", TypeConverters.toBoolean)
    precipKesal = Param(Params._dummy(), "precipKesal", "add PRECIP_KESAL", TypeConverters.toBoolean)
    resModRatio = Param(Params._dummy(), "resModRatio", "add RES_MOD_RATIO", TypeConverters.toBoolean)
    tempPrecip = Param(Params._dummy(), "tempPrecip", "add TEMP_PRECIP_PRODUCT", TypeConverters.toBoolean)
    useLog = Param(Params._dummy(), "useLog", "log1p on all features", TypeConverters.toBoolean)
    degree = Param(Params._dummy(), "degree", "polynomial degree", TypeConverters.toInt)
    interactionOnly = Param(Params._dummy(), "interactionOnly", "products of distinct columns only", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol="features", tempRatio=True, precipKesal=True, resModRatio=True,
                 tempPrecip=True, useLog=False, degree=1, interactionOnly=False):
        super().__init__()
        self._setDefault(outputCol="features", tempRatio=True, precipKesal=True, resModRatio=True, tempPrecip=True,
                         useLog=False, degree=1, interactionOnly=False)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def feature_names(self) -> list[str]:
        g = self.getOrDefault
        return list(g(self.inputCols)) + list(
            domain_columns(g(self.tempRatio), g(self.precipKesal), g(self.resModRatio), g(self.tempPrecip))
        )

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        base = list(g(self.inputCols))
        cols = {c: F.col(c).cast("double") for c in base} | domain_columns(
            g(self.tempRatio), g(self.precipKesal), g(self.resModRatio), g(self.tempPrecip)
        )
        if g(self.useLog):
            cols = {n: numeric.log1p(e) for n, e in cols.items()}
        helper = df.withColumns({f"_f_{n}": e for n, e in cols.items()})
        names = [f"_f_{n}" for n in cols]
        degree, out = g(self.degree), g(self.outputCol)
        if degree > 1 and g(self.interactionOnly):
            products = {n: e for n, e in poly_columns(names, degree, True).items() if "*" in n}
            helper = helper.withColumns({f"_p{i}": e for i, e in enumerate(products.values())})
            names = names + [f"_p{i}" for i in range(len(products))]
        expand = degree > 1 and not g(self.interactionOnly)
        vec = VectorAssembler(inputCols=names, outputCol="_flat" if expand else out, handleInvalid="keep").transform(helper)
        if expand:
            vec = PolynomialExpansion(degree=degree, inputCol="_flat", outputCol=out).transform(vec)
        return vec.select(*df.columns, out)
