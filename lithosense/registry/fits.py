"""Fitted models: forests, additive regression, search, explanation.

SQL repeats a learner only in cases it can solve exactly; those stand at the end.  The
others are checked by invariants in the tests.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler
from pyspark.sql import functions as F

from lithosense.constants import FEATURES, FOREST_SMALL, SEED, TARGET
from lithosense.models import additive, evaluate, forest as RF, grow, nodes as N, prepare as P, search as S
from lithosense.plans.ensemble import EnsembleConfig, fit_ensemble
from lithosense.registry.base import query, r, rnd, sql
from lithosense.session import materialise

KEYS = ["id", "line", "RES_MOD_AVG", "MAX_ANN_TEMP_DAYS"]
FEATS = list(FEATURES)
LIGHT = {"trees": 5, "depth": 8, "subset": 8, "leaf": 4}


def table(t):
    """The modelling table with missing thickness filled, written once for all passes over it."""
    return materialise(P.impute(t.model_table().drop("MATERIAL"), ["REPR_THICKNESS"]), "model-table")


def _forest(t, **conf):
    train, test = P.hash_split(table(t), KEYS)
    return RF.fit_forest(train, FEATS, TARGET, **{**LIGHT, **conf}), train, test


@query("hash_split")
def _(t):
    train, val, test = P.train_val_test(t.model_table(), KEYS)
    parts = [df.agg(F.lit(n).alias("split"), F.count(F.lit(1)).alias("n")) for n, df in (("train", train), ("val", val), ("test", test))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("fit_forest")
def _(t):
    """Metrics of the published forest; on larger tables it grows where its rows lie."""
    data = table(t)
    if not grow.small(data.count(), FOREST_SMALL["trees"], FOREST_SMALL["depth"]):
        blocks = grow.pack(data, FEATS, TARGET, [P.held_by_hash(KEYS)])
        found = grow.deep_scores(blocks, [grow.Fit(**FOREST_SMALL, held=1)])
        return found.select(F.when(F.col("held"), "test").otherwise("train").alias("split"), "r2", "mse", "mae", "n")
    train, test = P.hash_split(data, KEYS)
    model = RF.fit_forest(train, FEATS, TARGET, **FOREST_SMALL)
    parts = {"train": train, "test": test}
    scored = evaluate.pred_vs_actual({n: model.transform(RF.assemble(d, FEATS)) for n, d in parts.items()}, TARGET)
    return evaluate.metrics(scored, "actual", "predicted", ["split"])


@query("pred_vs_actual")
def _(t):
    model, train, test = _forest(t)
    return evaluate.pred_vs_actual({n: model.transform(RF.assemble(d, FEATS)) for n, d in (("train", train), ("test", test))}, TARGET)


@query("importance_forest")
def _(t):
    return RF.importance(_forest(t)[0], FEATS, t.spark)


@query("interaction_pairs")
def _(t):
    return RF.interaction_pairs(table(t), FEATS, TARGET, n=5, trees=10, depth=8)


@query("forest_report")
def _(t):
    return RF.forest_report(_forest(t)[0], t.spark)


@query("tree_dump")
def _(t):
    return RF.tree_dump(_forest(t, depth=4)[0], t.spark)


@query("tree_curve")
def _(t):
    """Train, test and cross-validation error of 1 to 50 untuned trees, ten random splits of the train rows."""
    splits = [P.held_by_hash(KEYS, 0.2, SEED + 101 * (i + 1)) for i in range(10)]
    found = N.grown_curve(table(t), FEATS, TARGET, KEYS, grow.Fit(trees=50, depth=RF.MAX_DEPTH, subset="all", leaf=1), splits)
    return found.select(F.col("part").alias("split"), "trees", "mse", "r2")


def _additive(t, pairs=(("ANL_KESAL_LTPP_LN_YR", "RES_MOD_AVG"),)):
    train, test = P.hash_split(table(t), KEYS)
    return additive.fit_additive(train, FEATS, TARGET, max_bins=32, pairs=list(pairs)), train, test


@query("fit_additive")
def _(t):
    model, train, test = _additive(t)
    scored = evaluate.pred_vs_actual({"train": model.transform(train), "test": model.transform(test)}, TARGET)
    return evaluate.metrics(scored, "actual", "predicted", ["split"])


@query("shape_table")
def _(t):
    return _additive(t)[0].shape_table(t.spark)


@query("pair_table")
def _(t):
    return _additive(t)[0].pair_table(t.spark)


@query("importance_additive")
def _(t):
    return _additive(t)[0].importance(t.spark)


@query("explain_local")
def _(t):
    model, _, test = _additive(t)
    return model.explain_local(test, KEYS)


def _fit(df, features_col, **conf):
    return RF.forest(TARGET, features_col=features_col, **{**LIGHT, **conf}).fit(df)


@query("cv_shuffle")
def _(t):
    """The published forest on ten random splits, five times over."""
    return S.cv_shuffle(table(t), grow.Fit(**FOREST_SMALL), TARGET, KEYS, splits=10, repeats=5, features=FEATS)


@query("cv_kfold")
def _(t):
    data = RF.assemble(table(t), FEATS)
    return S.cv_kfold(data, lambda d, col: _fit(d, col, trees=3), "features", TARGET, KEYS, k=3)


def _pipeline():
    builder = P.FeatureBuilder(inputCols=FEATS)
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    rf = RF.forest(TARGET, features_col="scaled", **{**LIGHT, "trees": 3})
    return Pipeline(stages=[builder, scaler, rf]), builder, scaler, rf


@query("grid_search")
def _(t):
    pipe, builder, scaler, rf = _pipeline()
    grid = S.param_grid({builder.tempRatio: [True, False], builder.useLog: [False, True], rf.maxDepth: [4, 8]})
    return S.grid_search(table(t), pipe, grid, TARGET, KEYS, k=2)[1]


@query("random_search")
def _(t):
    pipe, builder, scaler, rf = _pipeline()
    options = {rf.numTrees: list(range(2, 6)), rf.maxDepth: list(range(3, 9)), rf.minInstancesPerNode: [1, 2, 3, 4, 5, 6], builder.degree: [1, 2]}
    return S.random_search(table(t), pipe, options, TARGET, KEYS, n=20, k=2)[1]


@query("halving_search")
def _(t):
    pipe, builder, scaler, rf = _pipeline()
    grid = S.param_grid({rf.maxDepth: [3, 6], rf.minInstancesPerNode: [2, 5]})
    return S.halving_search(table(t), pipe, grid, TARGET, KEYS, k=2)[1]


@query("fit_ensemble")
def _(t):
    cfg = EnsembleConfig(keys=KEYS, forest=LIGHT, max_bins=32, interactions=3)
    return fit_ensemble(t.model_table().drop("MATERIAL"), cfg)[1]


# --- cases that SQL solves exactly ----------------------------------------------------
_MEANS = "SELECT {0} AS x, count(*) AS n, sum(MAX_MEAN_DEPTH_1_8) AS s FROM model_table GROUP BY 1"


@query("stump_split", sql(
    "SELECT x, n, " + r("CASE WHEN x <= cut THEN left_mean ELSE right_mean END", "predicted", 4) + " FROM means, best", "model_table",
    means=_MEANS.format("MAX_ANN_TEMP_AVG"),
    sides="""SELECT x AS cut, sum(n) OVER w AS n1, sum(s) OVER w AS s1, (SELECT sum(n) FROM means) AS n_all, (SELECT sum(s) FROM means) AS s_all
        FROM means WINDOW w AS (ORDER BY x)""",
    best="""SELECT cut, s1 / n1 AS left_mean, (s_all - s1) / (n_all - n1) AS right_mean FROM sides WHERE n1 < n_all
        ORDER BY s1 * s1 / n1 + (s_all - s1) * (s_all - s1) / (n_all - n1) DESC LIMIT 1"""))
def _(t):
    """One tree of one split over every row: the cut with the least squared error."""
    data = RF.assemble(t.model_table(), ["MAX_ANN_TEMP_AVG"])
    model = RF.forest(TARGET, trees=1, depth=1, subset="all", leaf=1, bootstrap=False).fit(data)
    scored = model.transform(data).groupBy(F.col("MAX_ANN_TEMP_AVG").alias("x"))
    return rnd(scored.agg(F.count(F.lit(1)).alias("n"), F.first("prediction").alias("predicted")), 4)


@query("additive_means", sql("SELECT x, n, " + r("s / n", "predicted", 3) + " FROM means", "model_table", means=_MEANS.format("CONSTRUCTION_NO")))
def _(t):
    """One feature, no penalty: the score of a bin is its mean."""
    data = t.model_table()
    model = additive.fit_additive(data, ["CONSTRUCTION_NO"], TARGET, max_bins=64, ridge=0.0)
    scored = model.transform(data).groupBy(F.col("CONSTRUCTION_NO").alias("x"))
    return rnd(scored.agg(F.count(F.lit(1)).alias("n"), F.first("prediction").alias("predicted")), 3)


@query("explain_sums", sql(f"SELECT DISTINCT {', '.join(KEYS)}, 0.0::DOUBLE AS gap FROM model_table WHERE REPR_THICKNESS IS NOT NULL", "model_table"))
def _(t):
    """Intercept and contributions add up to the prediction, for every key."""
    data = t.model_table().where(F.col("REPR_THICKNESS").isNotNull())
    model = additive.fit_additive(data, FEATS, TARGET, max_bins=32)
    rows = F.count(F.lit(1)) / len(FEATS)
    total = model.explain_local(data, KEYS).groupBy(*KEYS).agg((F.sum("contribution") + rows * model.intercept).alias("total"))
    both = model.transform(data).groupBy(*KEYS).agg(F.sum("prediction").alias("prediction")).join(total, KEYS)
    return both.select(*KEYS, (F.round(F.col("total") - F.col("prediction"), 6) + 0.0).alias("gap"))


@query("digest_split", sql("SELECT CASE WHEN ('0x' || left(md5(id || '|' || line), 8))::BIGINT % 10000 < 2000 THEN 'test' ELSE 'train' END AS split, count(*) AS n, "
    + r("avg(MAX_MEAN_DEPTH_1_8)", "mean") + " FROM model_table GROUP BY 1", "model_table"))
def _(t):
    """A split by the digest of the row's key."""
    return rnd(P.digest_split(t.model_table(), ["id", "line"]).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg(TARGET).alias("mean")))


@query("shape_means", sql("SELECT x AS value, n, " + r("s / n - (SELECT sum(s) / sum(n) FROM means)", "score", 3) + " FROM means", "model_table", means=_MEANS.format("CONSTRUCTION_NO")))
def _(t):
    """Without penalty the shape of a single feature is the distance of its bin means from the mean."""
    data = t.model_table()
    model = additive.fit_additive(data, ["CONSTRUCTION_NO"], TARGET, max_bins=64, ridge=0.0)
    shape = model.shape_table(t.spark).select("bin", "score", "n").where("n > 0")
    values = additive._bucketize(data.select("CONSTRUCTION_NO").distinct(), {"CONSTRUCTION_NO": model.edges["CONSTRUCTION_NO"]}, "bin_")
    return rnd(values.join(shape, F.col("bin_CONSTRUCTION_NO") == F.col("bin")).select(F.col("CONSTRUCTION_NO").alias("value"), "n", "score"), 3)


@query("stump_pred_vs_actual", sql(
    "SELECT 'all' AS split, " + r("MAX_MEAN_DEPTH_1_8", "actual", 4) + ", " + r("CASE WHEN MAX_ANN_TEMP_AVG <= cut THEN left_mean ELSE right_mean END", "predicted", 4) + " FROM model_table, best",
    "model_table", means=_MEANS.format("MAX_ANN_TEMP_AVG"),
    sides="""SELECT x AS cut, sum(n) OVER w AS n1, sum(s) OVER w AS s1, (SELECT sum(n) FROM means) AS n_all, (SELECT sum(s) FROM means) AS s_all
        FROM means WINDOW w AS (ORDER BY x)""",
    best="""SELECT cut, s1 / n1 AS left_mean, (s_all - s1) / (n_all - n1) AS right_mean FROM sides WHERE n1 < n_all
        ORDER BY s1 * s1 / n1 + (s_all - s1) * (s_all - s1) / (n_all - n1) DESC LIMIT 1"""))
def _(t):
    """Predictions of a one-split tree beside the target, a row each."""
    data = RF.assemble(t.model_table(), ["MAX_ANN_TEMP_AVG"])
    model = RF.forest(TARGET, trees=1, depth=1, subset="all", leaf=1, bootstrap=False).fit(data)
    return rnd(evaluate.pred_vs_actual({"all": model.transform(data)}, TARGET), 4)
