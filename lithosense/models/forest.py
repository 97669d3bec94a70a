"""Random forests: fit, importance, per-tree reports, learning curve."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from lithosense.constants import FOREST_SMALL, SEED
from lithosense.models.prepare import spread
from lithosense.operators.sets import ranked_pairs, top_n

MAX_DEPTH = 30  # Spark's limit; stands for "unlimited"
SHALLOW = 12


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep").transform(
        df.withColumns({c: F.col(c).cast("double") for c in features})
    )


def forest(
    label: str, trees: int = 5, depth: int | None = 22, subset: int | str = 8, leaf: int = 4,
    seed: int = SEED, max_bins: int = 128, features_col: str = "features", bootstrap: bool = True,
) -> RandomForestRegressor:
    """Estimator.  Node statistics are aggregated across tasks in groups that fit
    ``maxMemoryInMB``, which every task at work holds; node ids are cached so deep trees need
    no re-walk per level (in shallow ones the walk costs less).
    ``depth`` None means the deepest Spark grows (30); more is an error."""
    if depth is not None and depth > MAX_DEPTH:
        raise ValueError(f"trees cannot be deeper than {MAX_DEPTH}, asked for {depth}")
    return RandomForestRegressor(
        featuresCol=features_col, labelCol=label, numTrees=trees, maxDepth=MAX_DEPTH if depth is None else depth,
        featureSubsetStrategy=str(subset), minInstancesPerNode=leaf, maxBins=max_bins, seed=seed,
        maxMemoryInMB=256, cacheNodeIds=depth is None or depth > SHALLOW, checkpointInterval=10, bootstrap=bootstrap,
    )


def fit_forest(df: DataFrame, features: list[str], label: str, **settings) -> RandomForestRegressionModel:
    conf = {**FOREST_SMALL, **settings}
    conf["subset"] = conf["subset"] if isinstance(conf["subset"], str) else min(conf["subset"], len(features))
    return forest(label, **conf).fit(spread(assemble(df, features).select("features", F.col(label).cast("double").alias(label))))


def importance(model: RandomForestRegressionModel, features: list[str], spark) -> DataFrame:
    """(feature, importance), one row per feature."""
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature STRING, importance DOUBLE").orderBy(F.desc("importance"), "feature")


def interaction_pairs(df: DataFrame, features: list[str], label: str, n: int = 5, trees: int = 100, depth: int | None = None, **kw) -> DataFrame:
    """Pairs of the n most important features of a forest."""
    model = fit_forest(df, features, label, trees=trees, depth=depth, subset="all", leaf=1, **kw)
    best = top_n(importance(model, features, df.sparkSession), [F.desc("importance"), F.col("feature")], n)
    return ranked_pairs(best, "feature", "importance")


def forest_report(model: RandomForestRegressionModel, spark) -> DataFrame:
    """One row per tree: depth, nodes, and the settings it was grown with."""
    rows = [
        (i, t.depth, t.numNodes, (t.numNodes + 1) // 2, t.numFeatures, int(model.getMinInstancesPerNode()), model.getFeatureSubsetStrategy())
        for i, t in enumerate(model.trees)
    ]
    return spark.createDataFrame(
        rows, "tree INT, depth INT, nodes INT, leaves INT, features INT, min_leaf INT, feature_subset STRING"
    )


def tree_dump(model: RandomForestRegressionModel, spark, tree: int = 0) -> DataFrame:
    """The rules of one tree, one line per row."""
    lines = model.trees[tree].toDebugString.splitlines()
    return spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "line INT, rule STRING")


def tree_predictions(model: RandomForestRegressionModel, df: DataFrame) -> DataFrame:
    """Add array ``by_tree`` of the single trees' predictions."""
    out = df
    names = []
    for i, tree in enumerate(model.trees):
        names.append(f"_t{i}")
        out = tree.copy().setPredictionCol(names[-1]).transform(out)
    return out.withColumn("by_tree", F.array(*names)).drop(*names)


def tree_curve(model: RandomForestRegressionModel, df: DataFrame, label: str) -> DataFrame:
    """R² and MSE of the first k trees, k = 1..n, from one fit and one pass.

    A forest of k trees is the average of its first k trees, so refitting for
    every k is not needed; squared errors of all prefixes are summed together.
    """
    n = model.getNumTrees
    scored = tree_predictions(model, df).select(F.col(label).cast("double").alias("y"), "by_tree")
    total, prefixes = F.lit(0.0), []
    for k in range(n):
        total = total + F.get("by_tree", F.lit(k))
        err = F.col("y") - total / (k + 1)
        prefixes.append(F.avg(err * err).alias(f"m{k}"))
    row = scored.agg(F.var_pop("y").alias("v"), *prefixes)
    entries = F.array(*[F.struct(F.lit(k + 1).alias("trees"), F.col(f"m{k}").alias("mse")) for k in range(n)])
    return row.select("v", F.inline(entries)).select("trees", "mse", (1 - F.col("mse") / F.nullif("v", F.lit(0.0))).alias("r2"))
