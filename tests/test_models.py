"""Invariants of fitted models."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lithosense.constants import FEATURES, TARGET
from lithosense.models import additive, evaluate, forest as RF, prepare as P, search as S
from lithosense.plans.ensemble import EnsembleConfig, fit_ensemble
from lithosense.registry.base import Tables
from lithosense.registry.fits import KEYS

FEATS = list(FEATURES)


@pytest.fixture(scope="module")
def data(spark, sf):
    return P.impute(Tables(spark, sf).model_table().drop("MATERIAL"), ["REPR_THICKNESS"]).cache()


@pytest.fixture(scope="module")
def gam(data):
    return additive.fit_additive(data, FEATS, TARGET, max_bins=16, pairs=[("ANL_KESAL_LTPP_LN_YR", "MAX_ANN_TEMP_AVG")])


def test_hash_split_is_stable_and_whole(data):
    train, test = P.hash_split(data, KEYS)
    again = P.hash_split(data.repartition(3), KEYS)[1]
    assert train.count() + test.count() == data.count()
    assert test.exceptAll(again).count() == 0
    assert 0.15 < test.count() / data.count() < 0.25


def test_contributions_sum_to_the_prediction(data, gam):
    keyed = data.withColumn("row", F.monotonically_increasing_id()).cache()
    parts = gam.explain_local(keyed, ["row"]).groupBy("row").agg(F.sum("contribution").alias("s"))
    diff = gam.transform(keyed).join(parts, "row").agg(F.max(F.abs(F.col("prediction") - F.col("s") - gam.intercept))).first()[0]
    assert diff < 1e-9


def test_shapes_are_centred_and_cover_all_rows(data, gam, spark):
    t = gam.shape_table(spark)
    for r in t.groupBy("feature").agg(F.sum(F.col("score") * F.col("n")).alias("c"), F.sum("n").alias("n")).collect():
        assert abs(r["c"]) < 1e-6 * r["n"] and r["n"] == data.count()
    inner = t.where("mid IS NOT NULL").first()
    assert inner["mid"] == pytest.approx((inner["low"] + inner["high"]) / 2)


def test_additive_explains_the_signal(data, gam):
    assert evaluate.metrics(gam.transform(data), TARGET).first()["r2"] > 0.7
    missing = data.limit(1).withColumn("RES_MOD_AVG", F.lit(None).cast("double"))
    assert math.isfinite(gam.transform(missing).first()["prediction"])


def test_tree_curve_ends_at_the_forest(data):
    model = RF.fit_forest(data, FEATS, TARGET, trees=6, depth=6)
    scored = model.transform(RF.assemble(data, FEATS))
    curve = RF.tree_curve(model, RF.assemble(data, FEATS), TARGET).orderBy("trees").collect()
    assert len(curve) == 6
    assert curve[-1]["mse"] == pytest.approx(evaluate.metrics(scored, TARGET).first()["mse"])
    spark = data.sparkSession
    assert RF.importance(model, FEATS, spark).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    report = RF.forest_report(model, spark)
    assert report.count() == 6 and report.agg(F.max("depth")).first()[0] <= 6


def test_unlimited_depth_is_spark_limit():
    assert RF.forest("y", depth=None).getMaxDepth() == 30


def test_weight_search_equals_numpy(spark):
    rng = np.random.default_rng(0)
    y = rng.random(200)
    a, b = y + rng.normal(size=200) * 0.3, y + rng.normal(size=200) * 0.2
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(y, a, b)], "y DOUBLE, a DOUBLE, b DOUBLE")
    got = [(r["weight"], r["r2"]) for r in evaluate.weight_search(df, "y", "a", "b").orderBy("weight").collect()]
    want = [(k / 20, 1 - ((y - (k / 20 * a + (1 - k / 20) * b)) ** 2).sum() / ((y - y.mean()) ** 2).sum()) for k in range(21)]
    assert np.allclose(got, want)
    best = evaluate.best_weight(evaluate.weight_search(df, "y", "a", "b")).first()
    assert best["weight"] == max(want, key=lambda x: x[1])[0]


def test_feature_builder_switches(data):
    b = P.FeatureBuilder(inputCols=FEATS)
    size = lambda **kw: b.copy({getattr(b, k): v for k, v in kw.items()}).transform(data).first()["features"].size
    assert size() == 14 and size(tempRatio=False) == 13
    assert size(degree=2) == 14 + 14 * 15 // 2
    assert size(degree=2, interactionOnly=True) == 14 + 14 * 13 // 2
    logged = b.copy({b.useLog: True}).transform(data).select("features", "RES_MOD_AVG").first()
    assert logged["features"][8] == pytest.approx(math.log1p(logged["RES_MOD_AVG"]))


def test_feature_builder_saves_and_loads(data, tmp_path):
    b = P.FeatureBuilder(inputCols=FEATS, useLog=True)
    b.write().overwrite().save(str(tmp_path / "b"))
    assert P.FeatureBuilder.load(str(tmp_path / "b")).getOrDefault("useLog") is True


def test_random_candidates_are_seeded_and_distinct():
    rf = RF.forest("y")
    options = {rf.maxDepth: list(range(2, 9)), rf.numTrees: list(range(1, 6))}
    one, two = S.random_candidates(options, 10), S.random_candidates(options, 10)
    assert one == two and len({tuple(c.values()) for c in one}) == 10
    assert len(S.random_candidates(options, 1000)) == 35


def test_grid_and_halving(data):
    rf = RF.forest(TARGET, trees=2, depth=3)
    table = RF.assemble(data, FEATS)
    grid = S.param_grid({rf.maxDepth: [1, 5], rf.minInstancesPerNode: [2, 400]})
    best, found = S.grid_search(table, rf, grid, TARGET, KEYS, k=2)
    assert found.count() == 4 and found.first()["score"] == found.agg(F.min("score")).first()[0]
    assert best.getMaxDepth() == 5
    best, rounds = S.halving_search(table, rf, grid, TARGET, KEYS)
    assert [r["n"] for r in rounds.groupBy("round").agg(F.count("*").alias("n")).orderBy("round").collect()] == [4, 2]
    assert rounds.agg(F.max("share")).first()[0] == 1.0


def test_cross_validation_tables(data):
    table = RF.assemble(data, FEATS)
    fit = lambda df, col="features", **kw: RF.forest(TARGET, trees=2, depth=4, features_col=col, **kw).fit(df)
    shuffle = S.cv_shuffle(table, lambda df, seed: fit(df, seed=seed), TARGET, KEYS, splits=2, repeats=2)
    assert shuffle.count() == 4
    folds = S.cv_kfold(table, lambda df, col: fit(df, col), "features", TARGET, KEYS, k=3)
    summary = S.cv_summary(folds, ["test_r2"]).first()
    assert folds.count() == 3 and summary["mean_test_r2"] > 0.3


def test_ensemble_is_no_worse_than_its_parts_on_validation(spark, sf):
    cfg = EnsembleConfig(keys=KEYS, forest={"trees": 4, "depth": 6, "subset": 8, "leaf": 4}, max_bins=16, interactions=3)
    model, report = fit_ensemble(Tables(spark, sf).model_table().drop("MATERIAL"), cfg)
    r2 = {r["model"]: r["r2"] for r in report.where("split = 'val'").collect()}
    assert r2["ensemble"] >= max(r2["rf"], r2["additive"]) - 1e-12
    assert 0.0 <= model.weight <= 1.0


def test_folds_read_rows_that_are_dealt_once(spark, monkeypatch):
    """Every fit and scoring reads the kept rows; they are given back at the end."""
    from pyspark import StorageLevel
    from pyspark.sql import functions as F

    from lithosense.models import prepare, search

    monkeypatch.setattr(prepare.spread, "__defaults__", (40,))
    df = spark.range(200).select("id", (F.col("id") % 7).cast("double").alias("y"))
    levels = []

    class Mean:
        def transform(self, held):
            return held.withColumn("prediction", F.lit(3.0))

    def fit(train, seed):
        plan = train._jdf.queryExecution().withCachedData().toString()
        levels.append("InMemoryRelation" in plan)
        return Mean()

    with prepare.dealt(df) as rows:
        assert rows.rdd.getNumPartitions() == 5 and rows.storageLevel == StorageLevel.DISK_ONLY
    assert rows.storageLevel == StorageLevel.NONE
    scores = search.cv_shuffle(df, fit, "y", ["id"], splits=2, repeats=2)
    assert levels == [True] * 4 and scores.count() == 4
