"""Explainable additive regression: ŷ = β₀ + Σ fᵢ(xᵢ) + Σ fᵢⱼ(xᵢ, xⱼ).

Each fᵢ is piecewise constant on quantile bins; all levels are fitted together as
one ridge regression on sparse indicators.  The coefficients are the shape
functions, so explanation is a look-up.  Scoring is a join-free column expression.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer, OneHotEncoder, QuantileDiscretizer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, functions as F

from lithosense.models.prepare import spread


@dataclass
class AdditiveModel:
    """Model state is bounded by bins × features (+ pair cells), never by rows."""

    features: list[str]
    edges: dict[str, list[float]]
    scores: dict[str, list[float]]
    counts: dict[str, list[int]]
    intercept: float
    pairs: list[tuple[str, str]] = field(default_factory=list)
    pair_edges: dict[str, list[float]] = field(default_factory=dict)
    pair_scores: dict[tuple[str, str], list[float]] = field(default_factory=dict)
    missing: dict[str, float] = field(default_factory=dict)
    spread: dict[str, list[float]] = field(default_factory=dict)  # deviation of scores over bags, if bagged
    pair_spread: dict[tuple[str, str], list[float]] = field(default_factory=dict)

    def _bins(self, df: DataFrame) -> DataFrame:
        return _bucketize(_bucketize(df, self.edges, "_b_"), self.pair_edges, "_c_")

    def _terms(self) -> dict[str, Column]:
        terms = {f: _lookup([*self.scores[f], self.missing.get(f, 0.0)], F.col(f"_b_{f}").cast("int")) for f in self.features}
        for a, b in self.pairs:
            width = len(self.pair_edges[b]) - 1
            inside = (F.col(f"_c_{a}") < len(self.pair_edges[a]) - 1) & (F.col(f"_c_{b}") < width)
            cell = F.when(inside, (F.col(f"_c_{a}") * width + F.col(f"_c_{b}")).cast("int"))
            terms[f"{a} x {b}"] = _lookup(self.pair_scores[a, b], cell)
        return terms

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        total = F.lit(self.intercept)
        for t in self._terms().values():
            total = total + t
        return self._bins(df).withColumn(out, total).select(*df.columns, out)

    def explain_local(self, df: DataFrame, ids: list[str]) -> DataFrame:
        """(ids, feature, contribution) per row; with the intercept they sum to the prediction."""
        entries = F.array(*[F.struct(F.lit(n).alias("feature"), t.alias("contribution")) for n, t in self._terms().items()])
        return self._bins(df).select(*ids, F.inline(entries))

    def shape_table(self, spark) -> DataFrame:
        """(feature, bin, low, high, mid, score, n, std); ``std`` is the scores' deviation over bags."""
        rows = []
        for f in self.features:
            e = self.edges[f]
            for b, s in enumerate(self.scores[f]):
                lo, hi = e[b], e[b + 1]
                mid = (lo + hi) / 2 if abs(lo) != float("inf") and abs(hi) != float("inf") else None
                std = self.spread[f][b] if f in self.spread else None
                rows.append((f, b, lo, hi, mid, s, self.counts[f][b], std))
        return spark.createDataFrame(
            rows, "feature STRING, bin INT, low DOUBLE, high DOUBLE, mid DOUBLE, score DOUBLE, n BIGINT, std DOUBLE"
        )

    def pair_table(self, spark) -> DataFrame:
        """(f1, f2, b1, b2, score, std)."""
        rows = []
        for (a, b), cells in self.pair_scores.items():
            width = len(self.pair_edges[b]) - 1
            std = self.pair_spread.get((a, b), [None] * len(cells))
            rows += [(a, b, i // width, i % width, s, std[i]) for i, s in enumerate(cells)]
        return spark.createDataFrame(rows, "f1 STRING, f2 STRING, b1 INT, b2 INT, score DOUBLE, std DOUBLE")

    def importance(self, spark) -> DataFrame:
        return self.shape_table(spark).groupBy("feature").agg(F.sum(F.abs("score")).alias("importance")).orderBy(
            F.desc("importance"), "feature"
        )


def _lookup(values: list[float], index: Column) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(float(v)) for v in values]), index), F.lit(0.0))


def _bucketize(df: DataFrame, edges: dict[str, list[float]], prefix: str) -> DataFrame:
    if not edges:
        return df
    names = list(edges)
    missing = F.lit(float("nan"))  # goes to the extra last bin
    typed = df.withColumns({f"_x_{c}": F.coalesce(F.col(c).cast("double"), missing) for c in names})
    b = Bucketizer(
        splitsArray=[edges[c] for c in names], inputCols=[f"_x_{c}" for c in names],
        outputCols=[f"{prefix}{c}" for c in names], handleInvalid="keep",
    )
    return b.transform(typed).drop(*[f"_x_{c}" for c in names])


def quantile_edges(df: DataFrame, features: list[str], bins: int) -> dict[str, list[float]]:
    """Bin edges from mergeable quantile sketches, one pass for all features."""
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in features])
    d = QuantileDiscretizer(
        numBucketsArray=[bins] * len(features), inputCols=features, outputCols=[f"_q_{c}" for c in features],
        handleInvalid="keep", relativeError=1.0 / (4 * bins),
    ).fit(typed)
    splits = d.getSplitsArray()
    return {c: list(s) for c, s in zip(features, splits)}


def fit_additive(
    df: DataFrame, features: list[str], label: str, max_bins: int = 64, pairs: list[tuple[str, str]] = (),
    pair_bins: int = 8, ridge: float = 1e-3, max_iter: int = 100,
) -> AdditiveModel:
    pairs = [tuple(p) for p in pairs]
    edges = quantile_edges(df, features, max_bins)
    used = sorted({f for p in pairs for f in p}, key=features.index)
    pair_edges = quantile_edges(df, used, pair_bins) if used else {}
    binned = _bucketize(_bucketize(df.withColumn(label, F.col(label).cast("double")), edges, "_b_"), pair_edges, "_c_")
    # Missing values fall in one extra bin per feature (no cell of a pair).
    sizes = [len(edges[f]) - 1 for f in features]
    columns = [f"_b_{f}" for f in features]
    for a, b in pairs:
        width = len(pair_edges[b]) - 1
        cell = F.col(f"_c_{a}") * width + F.col(f"_c_{b}")
        cells = (len(pair_edges[a]) - 1) * width
        inside = (F.col(f"_c_{a}") < len(pair_edges[a]) - 1) & (F.col(f"_c_{b}") < width)
        binned = binned.withColumn(f"_p_{a}_{b}", F.when(inside, cell).otherwise(F.lit(float(cells))))
        columns.append(f"_p_{a}_{b}")
        sizes.append(cells)
    binned = spread(binned.select(label, *columns))
    hot, widths = _one_hot(binned, columns)
    flat = VectorAssembler(inputCols=[f"{c}_hot" for c in columns], outputCol="_features").transform(hot)
    lr = LinearRegression(
        featuresCol="_features", labelCol=label, regParam=ridge, elasticNetParam=0.0, standardization=False,
        solver="l-bfgs", maxIter=max_iter, aggregationDepth=3,
    ).fit(flat.select("_features", label))
    beta = list(lr.coefficients.toArray())
    intercept = float(lr.intercept)

    counts = _bin_counts(binned, features, sizes)
    scores, missing, pair_scores, at = {}, {}, {}, 0
    for i, f in enumerate(features):
        raw, at = _padded(beta[at : at + widths[i]], sizes[i] + 1), at + widths[i]
        n = counts[f]
        mean = sum(r * k for r, k in zip(raw, n)) / (sum(n) or 1)
        scores[f] = [float(r - mean) for r in raw[: sizes[i]]]
        missing[f] = float(raw[sizes[i]] - mean)
        intercept += mean
    for i, (a, b) in enumerate(pairs, start=len(features)):
        pair_scores[a, b], at = _padded(beta[at : at + widths[i]], sizes[i]), at + widths[i]
    return AdditiveModel(features, edges, scores, counts, intercept, pairs, pair_edges, pair_scores, missing)


def _padded(values: list[float], size: int) -> list[float]:
    """Bins that no row fell into have no coefficient: 0."""
    return [float(v) for v in values[:size]] + [0.0] * max(0, size - len(values))


def _one_hot(df: DataFrame, columns: list[str]) -> tuple[DataFrame, list[int]]:
    """Sparse indicators and their widths.  The fit is one distributed max per column."""
    model = OneHotEncoder(
        inputCols=columns, outputCols=[f"{c}_hot" for c in columns], dropLast=False, handleInvalid="error"
    ).fit(df)
    return model.transform(df), list(model.categorySizes)


def _bin_counts(binned: DataFrame, features: list[str], sizes: list[int]) -> dict[str, list[int]]:
    """Rows per bin: at most bins × features numbers."""
    long = binned.select(*[F.col(f"_b_{f}").cast("int").alias(f) for f in features]).unpivot([], features, "feature", "bin")
    counts = {f: [0] * s for f, s in zip(features, sizes)}
    for r in long.groupBy("feature", "bin").count().collect():
        if r["bin"] is not None and r["bin"] < len(counts[r["feature"]]):
            counts[r["feature"]][r["bin"]] = r["count"]
    return counts


def residual_shape(df: DataFrame, features: list[str], label: str, prediction: str, bins: int = 16) -> DataFrame:
    """(feature, bin, mid, score, n): mean residual on equal-width bins, one pass after
    the ranges; a quick check of what a model still misses along each feature."""
    span = df.agg(F.struct(*[F.struct(F.min(f).cast("double").alias("lo"), F.max(f).cast("double").alias("hi")).alias(f) for f in features]).alias("x")).first()["x"]
    entries = []
    for f in features:
        lo, hi = span[f]["lo"], span[f]["hi"]
        width = ((hi - lo) / bins) if lo is not None and hi > lo else 1.0
        idx = F.least(F.floor((F.col(f).cast("double") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1).cast("bigint")).cast("int")
        entries.append(F.struct(F.lit(f).alias("feature"), idx.alias("bin"), (F.lit(lo) + (idx + 0.5) * width).alias("mid")))
    long = df.select((F.col(label) - F.col(prediction)).alias("r"), F.inline(F.array(*entries))).where(F.col("bin").isNotNull())
    return long.groupBy("feature", "bin", "mid").agg(F.avg("r").alias("score"), F.count(F.lit(1)).alias("n"))
