"""Boosted additive regression, bags, pairs, forests as tables, shared grids, adaptive search."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithosense.constants import FEATURES, FOREST_TUNED, TARGET
from lithosense.models import adaptive as D, boosting as B, evaluate, forest as RF, grow, nodes as N, prepare as P
from lithosense.registry.base import query, r, rnd, sql
from lithosense.registry.fits import KEYS, table
from lithosense.session import scratch_path

FEATS = list(FEATURES)
ROW = ["id", "line"]

# --- bags ---------------------------------------------------------------------------------
_CDF = [f"floor(4294967296 * ({' + '.join(f'1.0::DOUBLE / {f}' for f in fact)}) * exp(-1.0::DOUBLE))::BIGINT"
        for fact in ([1, 1, 2, 6, 24, 120, 720, 5040][:k] for k in range(1, 9))]
_BAGS = f"""SELECT b.bag, t.*, {' + '.join(f'(h >= {c})::INT' for c in _CDF)} AS weight FROM (
    SELECT CONSTRUCTION_NO, MAX_MEAN_DEPTH_1_8, bag, ('0x' || left(md5(id || '|' || line || '|' || bag), 8))::BIGINT AS h FROM model_table, range(4) x(bag)) t
    JOIN (SELECT range AS bag FROM range(4)) b ON b.bag = t.bag"""


@query("bag_weights", sql("SELECT bag::INT AS bag, weight, count(*) AS n FROM bags GROUP BY ALL", "model_table", bags=_BAGS.replace("t.*, ", "")))
def _(t):
    """How many rows each of four bags drew once, twice, ..."""
    return B.bag_counts(t.model_table(), ROW, 4)


@query("bag_means", sql(f"SELECT bag::INT AS bag, CONSTRUCTION_NO, sum(weight)::BIGINT AS weight, {r('sum(weight * MAX_MEAN_DEPTH_1_8) / sum(weight)', 'mean')} FROM bags GROUP BY 1, 2",
    "model_table", bags=_BAGS.replace("t.*", "CONSTRUCTION_NO, MAX_MEAN_DEPTH_1_8")))
def _(t):
    """The target's mean by construction number in each bag."""
    return rnd(B.bag_means(t.model_table(), "CONSTRUCTION_NO", TARGET, ROW, 4))


# --- rounds and pairs that SQL repeats ------------------------------------------------------
def _step(number: int, feature: str) -> str:
    before = f"s{number - 1}"
    return f"SELECT *, p + 0.5 * avg(MAX_MEAN_DEPTH_1_8 - p) OVER (PARTITION BY {feature}) AS q FROM (SELECT * EXCLUDE (p, q), q AS p FROM {before})"


@query("boosted_two_rounds", sql(
    f"SELECT CONSTRUCTION_NO AS x1, MR_MATL_TYPE AS x2, count(*) AS n, {r('min(q)', 'predicted', 4)} FROM s4 GROUP BY 1, 2", "model_table",
    s0="SELECT CONSTRUCTION_NO, MR_MATL_TYPE, MAX_MEAN_DEPTH_1_8, 0.0::DOUBLE AS p, avg(MAX_MEAN_DEPTH_1_8) OVER () AS q FROM model_table",
    s1=_step(1, "CONSTRUCTION_NO"), s2=_step(2, "MR_MATL_TYPE"), s3=_step(3, "CONSTRUCTION_NO"), s4=_step(4, "MR_MATL_TYPE")))
def _(t):
    """Two rounds over two features, one leaf a value, half of each residual mean taken."""
    conf = B.Boosting(rounds=2, rate=0.5, leaves=None, min_leaf=0.0, bags=0)
    data = t.model_table()
    model = B.fit_boosted(data, ["CONSTRUCTION_NO", "MR_MATL_TYPE"], TARGET, ROW, conf)
    scored = model.transform(data).groupBy(F.col("CONSTRUCTION_NO").alias("x1"), F.col("MR_MATL_TYPE").alias("x2"))
    return rnd(scored.agg(F.count(F.lit(1)).alias("n"), F.min("prediction").alias("predicted")), 4)


_PAIRED = ("CONSTRUCTION_NO", "ANL_KESAL_LTPP_LN_YR", "MAX_ANN_TEMP_AVG", "MAX_ANN_TEMP_DAYS", "DAYS_ABOVE_32_C_YR")
_GRID = 6
_BIN = "least(floor(({0} - (SELECT min({0}) FROM model_table)) * {1} / (SELECT max({0}) - min({0}) FROM model_table)), {1} - 1)::INT"
_COUPLES = [(a, b) for i, a in enumerate(_PAIRED) for b in _PAIRED[i + 1 :]]
_PART = "coalesce(sum(s) FILTER ({0}) * sum(s) FILTER ({0}) / sum(n) FILTER ({0}), 0)"


@query("pair_gains", sql(
    f"SELECT f1, f2, {r('max(gain)', 'gain', 3)} FROM gains GROUP BY 1, 2", "model_table",
    binned=f"SELECT MAX_MEAN_DEPTH_1_8 - avg(MAX_MEAN_DEPTH_1_8) OVER () AS res, {', '.join(_BIN.format(f, _GRID) + f' AS b_{f}' for f in _PAIRED)} FROM model_table",
    cells=" UNION ALL ".join(f"SELECT '{a}' AS f1, '{b}' AS f2, b_{a} AS i, b_{b} AS j, sum(res) AS s, count(*) AS n FROM binned GROUP BY ALL" for a, b in _COUPLES),
    gains=f"""SELECT f1, f2, ci, cj, {' + '.join(_PART.format(f'i {x} ci AND j {y} cj') for x in ('<=', '>') for y in ('<=', '>'))} - sum(s) * sum(s) / sum(n) AS gain
        FROM cells, range({_GRID - 1}) x(ci), range({_GRID - 1}) y(cj) GROUP BY ALL"""))
def _(t):
    """What the best corner of each of ten pairs takes off the squared residuals."""
    data = t.model_table()
    span = data.agg(*[F.struct(F.min(f).alias("lo"), F.max(f).alias("hi")).alias(f) for f in _PAIRED]).first()
    bins = {f: F.least(F.floor((F.col(f) - span[f]["lo"]) * _GRID / (span[f]["hi"] - span[f]["lo"])), F.lit(_GRID - 1)).cast("int") for f in _PAIRED}
    mean = data.agg(F.avg(TARGET)).scalar()
    gains = B.pair_gains(data.withColumn("res", F.col(TARGET) - mean), bins, dict.fromkeys(_PAIRED, _GRID), "res")
    return rnd(gains.select("f1", "f2", "gain"), 3)


# --- whole fits -----------------------------------------------------------------------------
BOOSTED = B.Boosting(rounds=400, rate=0.1, bags=4, max_bins=32, interactions=5)


def _boosted(t):
    train, test = P.hash_split(table(t), KEYS)
    return B.fit_boosted(train, FEATS, TARGET, ROW, BOOSTED), train, test


@query("fit_boosted")
def _(t):
    """Metrics of the boosted model with five found pairs."""
    model, train, test = _boosted(t)
    return evaluate.metrics(evaluate.pred_vs_actual({"train": model.transform(train), "test": model.transform(test)}, TARGET), "actual", "predicted", ["split"])


@query("boosted_shapes")
def _(t):
    """Shape functions with their deviation over bags."""
    return _boosted(t)[0].shape_table(t.spark)


@query("boosted_pairs")
def _(t):
    """Tables of the pairs that the search chose, with their deviation over bags."""
    return _boosted(t)[0].pair_table(t.spark)


# --- forests as tables ------------------------------------------------------------------------
def _stumps(t):
    """Three trees of one split each, every row and feature in all of them."""
    data = t.model_table()
    model = RF.forest(TARGET, trees=3, depth=1, subset="all", leaf=1, bootstrap=False).fit(RF.assemble(data, ["CONSTRUCTION_NO"]))
    return N.forest_nodes(model, ["CONSTRUCTION_NO"])


_SIDES = """SELECT x AS cut, sum(n) OVER w AS n1, sum(s) OVER w AS s1, (SELECT sum(n) FROM means) AS n_all, (SELECT sum(s) FROM means) AS s_all
    FROM means WINDOW w AS (ORDER BY x)"""
_BEST = """SELECT cut, n1, s1, n_all, s_all FROM sides WHERE n1 < n_all ORDER BY s1 * s1 / n1 + (s_all - s1) * (s_all - s1) / (n_all - n1) DESC LIMIT 1"""
_MEANS = "SELECT CONSTRUCTION_NO AS x, count(*) AS n, sum(MAX_MEAN_DEPTH_1_8) AS s FROM model_table GROUP BY 1"


@query("forest_leaf_rows", sql(
    f"""SELECT tree::INT AS tree, side, "rows"::BIGINT AS "rows", {r('p', 'prediction', 4)} FROM range(3) x(tree), (
        SELECT 'L' AS side, n1 AS "rows", s1 / n1 AS p FROM best UNION ALL SELECT 'R', n_all - n1, (s_all - s1) / (n_all - n1) FROM best)""",
    "model_table", means=_MEANS, sides=_SIDES, best=_BEST))
def _(t):
    """Rows and means of the leaves of one-split trees: together the whole table, in every tree."""
    return rnd(_stumps(t).where("leaf").select("tree", "side", "rows", "prediction"), 4)


@query("forest_rules", sql(
    "SELECT tree::INT AS tree, 'CONSTRUCTION_NO ' || op || ' ' || (cut + 0.5)::VARCHAR AS rule FROM range(3) x(tree), best, (VALUES ('<='), ('>')) o(op)",
    "model_table", means=_MEANS, sides=_SIDES, best=_BEST))
def _(t):
    """The rule of every leaf of every tree."""
    return N.forest_paths(_stumps(t)).select("tree", "rule")


@query("forest_nodes")
def _(t):
    """Every node of a tuned forest: all trees."""
    train, _ = P.hash_split(table(t), KEYS)
    if not grow.small(train.count(), FOREST_TUNED["trees"], FOREST_TUNED["depth"]):
        return grow.forest_nodes(grow.pack(train, FEATS, TARGET), grow.Fit(**FOREST_TUNED))
    model = RF.fit_forest(train, FEATS, TARGET, **FOREST_TUNED)
    return N.forest_nodes(model, FEATS)


@query("cv_curve")
def _(t):
    """Train, test and cross-validation error of 1 to 50 trees from four fits."""
    return N.cv_curve(table(t), FEATS, TARGET, KEYS, trees=50, k=3, depth=8, subset=5, leaf=3)


@query("shared_grid")
def _(t):
    """200 candidates from four forests on each of two folds."""
    return N.shared_grid(table(t), FEATS, TARGET, KEYS, trees=[1, 2, 5, 10, 20], depths=list(range(3, 13)), subsets=[5, 8], leaves=[2, 4], k=2)


@query("adaptive_search")
def _(t):
    """Twelve trials over a tree's settings, each two folds; the history is a table."""
    from lithosense.models.search import with_folds

    data = table(t)
    if grow.small(data.count(), 3 * 2, RF.SHALLOW):
        folded = P.spread(with_folds(RF.assemble(data, FEATS), KEYS, 2))

        def objective(params: dict) -> float:
            scores = []
            for fold in range(2):
                model = RF.forest(TARGET, trees=3, depth=params["depth"], subset=params["subset"], leaf=params["leaf"]).fit(folded.where(F.col("fold") != fold))
                scores.append(evaluate.metrics(model.transform(folded.where(F.col("fold") == fold)), TARGET).first()["mse"])
            return sum(scores) / 2
    else:
        blocks = grow.pack(with_folds(data, KEYS, 2), FEATS, TARGET, [F.col("fold") == 0, F.col("fold") == 1])

        def objective(params: dict) -> float:
            fits = [grow.Fit(3, params["depth"], params["subset"], params["leaf"], held=1 << fold) for fold in range(2)]
            return grow.shallow_scores(blocks, fits, [3], [params["depth"]], learned=False).agg(F.avg("mse")).first()[0]

    space = {"depth": D.IntRange(2, 12), "leaf": D.IntRange(1, 9), "subset": D.Choice((3, 5, 8, "all"))}
    return D.adaptive_search(t.spark, objective, space, scratch_path(t.spark, "trials"), trials=12, warm=5)
