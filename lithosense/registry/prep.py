"""Model preparation and metrics that SQL can repeat."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithosense.models import additive, evaluate, prepare as P
from lithosense.registry.base import query, r, rnd, sql

ID = ("id", "line", "RES_MOD_AVG", "MAX_ANN_TEMP_DAYS")
_ID = "id, line, RES_MOD_AVG, MAX_ANN_TEMP_DAYS"


@query("split", sql("SELECT CASE WHEN id % 10 < 8 THEN 'train' ELSE 'test' END AS split, count(*) AS n FROM model_table GROUP BY 1", "model_table"))
def _(t):
    return P.modulo_split(t.model_table(), "id").groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("impute", sql(f"""SELECT {_ID}, coalesce(REPR_THICKNESS, (SELECT quantile_cont(REPR_THICKNESS, 0.5) FROM model_table)) AS REPR_THICKNESS,
    coalesce(MATERIAL, (SELECT MATERIAL FROM model_table WHERE MATERIAL IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS MATERIAL FROM model_table""", "model_table"))
def _(t):
    return P.impute(t.model_table(), ["REPR_THICKNESS"], ["MATERIAL"]).select(*ID, "REPR_THICKNESS", "MATERIAL")


@query("impute_mean", sql(f"SELECT {_ID}, {r('coalesce(REPR_THICKNESS, (SELECT avg(REPR_THICKNESS) FROM model_table))', 'REPR_THICKNESS')} FROM model_table", "model_table"))
def _(t):
    return rnd(P.impute_mean(t.model_table(), ["REPR_THICKNESS"]).select(*ID, "REPR_THICKNESS"))


@query("impute_all_with_mean_of", sql(f"SELECT id, line, {r('coalesce(REPR_THICKNESS, (SELECT avg(RES_MOD_AVG) FROM model_table))', 'REPR_THICKNESS')}, MAX_ANN_TEMP_AVG FROM model_table", "model_table"))
def _(t):
    return rnd(P.impute_mean(t.model_table(), ["REPR_THICKNESS", "MAX_ANN_TEMP_AVG"], "RES_MOD_AVG").select("id", "line", "REPR_THICKNESS", "MAX_ANN_TEMP_AVG"))


_Z = "SELECT avg(MAX_MEAN_DEPTH_1_8) AS m, stddev_pop(MAX_MEAN_DEPTH_1_8) AS s FROM model_table"


@query("outliers_clip", sql(f"SELECT {_ID}, MAX_MEAN_DEPTH_1_8 FROM model_table, z WHERE abs((MAX_MEAN_DEPTH_1_8 - m) / s) < 1.5", "model_table", z=_Z))
def _(t):
    return P.handle_outliers(t.model_table(), "MAX_MEAN_DEPTH_1_8", "clip", 1.5).select(*ID, "MAX_MEAN_DEPTH_1_8")


@query("outliers_winsorize", sql(f"SELECT {_ID}, {r('least(greatest(MAX_MEAN_DEPTH_1_8, m - 1.5 * s), m + 1.5 * s)', 'MAX_MEAN_DEPTH_1_8')} FROM model_table, z", "model_table", z=_Z))
def _(t):
    return rnd(P.handle_outliers(t.model_table(), "MAX_MEAN_DEPTH_1_8", "winsorize", 1.5).select(*ID, "MAX_MEAN_DEPTH_1_8"))


@query("scale_robust", sql(
    "SELECT id, line, " + ", ".join(r(f"({c} - (SELECT quantile_cont({c}, 0.5) FROM model_table)) / (SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM model_table)", c) for c in ("RES_MOD_AVG", "REPR_THICKNESS"))
    + " FROM model_table", "model_table"))
def _(t):
    return rnd(P.scale_robust(t.model_table(), ["RES_MOD_AVG", "REPR_THICKNESS"]).select("id", "line", "RES_MOD_AVG", "REPR_THICKNESS"))


@query("scale_standard", sql(
    "SELECT id, line, " + ", ".join(r(f"({c} - (SELECT avg({c}) FROM model_table)) / (SELECT stddev_pop({c}) FROM model_table)", c) for c in ("RES_MOD_AVG", "REPR_THICKNESS"))
    + " FROM model_table", "model_table"))
def _(t):
    return rnd(P.scale_standard(t.model_table(), ["RES_MOD_AVG", "REPR_THICKNESS"]).select("id", "line", "RES_MOD_AVG", "REPR_THICKNESS"))


@query("domain_features", sql("SELECT id, line, RES_MOD_AVG, " + ", ".join([
    r("MAX_ANN_TEMP_DAYS / (MAX_ANN_TEMP_AVG + 1e-6)", "TEMP_RATIO"), r("TOTAL_ANN_PRECIP * ANL_KESAL_LTPP_LN_YR", "PRECIP_KESAL"),
    r("RES_MOD_AVG / (REPR_THICKNESS + 1e-6)", "RES_MOD_RATIO"), r("MAX_ANN_TEMP_AVG * TOTAL_ANN_PRECIP", "TEMP_PRECIP_PRODUCT")]) + " FROM model_table", "model_table"))
def _(t):
    df = P.domain_features(t.model_table()).select("id", "line", "RES_MOD_AVG", "TEMP_RATIO", "PRECIP_KESAL", "RES_MOD_RATIO", "TEMP_PRECIP_PRODUCT")
    return df.withColumns({c: F.round(F.col(c) + 1.7e-9, 6) for c in df.columns[3:]})


@query("log_features", sql(f"SELECT id, line, {r('ln(1 + RES_MOD_AVG)', 'RES_MOD_AVG')}, {r('ln(1 + MAX_ANN_TEMP_AVG)', 'MAX_ANN_TEMP_AVG')} FROM model_table", "model_table"))
def _(t):
    return rnd(P.log_features(t.model_table(), ["RES_MOD_AVG", "MAX_ANN_TEMP_AVG"]).select("id", "line", "RES_MOD_AVG", "MAX_ANN_TEMP_AVG"))


_A, _B = "ANL_KESAL_LTPP_LN_YR", "MAX_ANN_TEMP_AVG"


@query("poly", sql(f"SELECT id, line, {_A} AS a, {_B} AS b, {_A} * {_A} AS aa, {_A} * {_B} AS ab, {_B} * {_B} AS bb, {_A} * {_A} * {_B} AS aab FROM model_table", "model_table"))
def _(t):
    df = P.poly(t.model_table().select("id", "line", F.col(_A).alias("a"), F.col(_B).alias("b")), ["a", "b"], 3)
    return df.select("id", "line", "a", "b", *[F.col(f"`{n}`").alias(n.replace("*", "")) for n in ("a*a", "a*b", "b*b", "a*a*b")])


@query("poly_interactions", sql(f"SELECT id, line, {_A} * {_B} AS ab FROM model_table", "model_table"))
def _(t):
    df = P.poly(t.model_table().select("id", "line", F.col(_A).alias("a"), F.col(_B).alias("b")), ["a", "b"], 2, interaction_only=True)
    return df.select("id", "line", F.col("`a*b`").alias("ab"))


@query("power_blocks", sql(f"SELECT id, line, {_A} AS a, pow({_A}, 2) AS a2, pow({_A}, 3) AS a3 FROM model_table", "model_table"))
def _(t):
    df = P.power_blocks(t.model_table().select("id", "line", F.col(_A).alias("a")), ["a"], 3)
    return df.select("id", "line", "a", F.col("`a^2`").alias("a2"), F.col("`a^3`").alias("a3"))


# --- metrics and weights ------------------------------------------------------------------
def _r2(pred: str) -> str:
    return f"1 - sum((y - ({pred})) * (y - ({pred}))) / sum((y - my) * (y - my))"


_PM = {"p": "SELECT *, avg(y) OVER () AS my FROM predictions"}


@query("metrics", sql(
    f"SELECT {r(_r2('pred_a'), 'r2')}, {r('avg((y - pred_a) * (y - pred_a))', 'mse', 0)}, {r('avg(abs(y - pred_a))', 'mae', 3)}, count(*) AS n FROM p", "predictions", **_PM))
def _(t):
    m = evaluate.metrics(t.predictions(), "y", "pred_a")
    return m.select(F.round(F.col("r2") + 1.7e-9, 6).alias("r2"), F.round(F.col("mse") + 1.7e-3, 0).alias("mse"), F.round(F.col("mae") + 1.7e-6, 3).alias("mae"), "n")


_W = " UNION ALL ".join(f"SELECT {k} / 20.0::DOUBLE AS weight, {r(_r2(f'{k} / 20.0::DOUBLE * pred_a + (1 - {k} / 20.0::DOUBLE) * pred_b'), 'r2')} FROM p" for k in range(21))


@query("ensemble_weights", sql(_W, "predictions", **_PM))
def _(t):
    return rnd(evaluate.weight_search(t.predictions(), "y", "pred_a", "pred_b").withColumn("weight", F.col("weight"))).withColumn("weight", F.round("weight", 2))


@query("best_weight", sql("SELECT weight, r2 FROM w ORDER BY r2 DESC, weight LIMIT 1", "predictions", **_PM, w=_W))
def _(t):
    best = evaluate.best_weight(evaluate.weight_search(t.predictions(), "y", "pred_a", "pred_b"))
    return best.select(F.round("weight", 2).alias("weight"), F.round(F.col("r2") + 1.7e-9, 6).alias("r2"))


@query("blend", sql(f"SELECT id, line, y, {r('0.35 * pred_a + 0.65 * pred_b', 'prediction', 4)} FROM predictions", "predictions"))
def _(t):
    df = evaluate.blend(t.predictions(), "pred_a", "pred_b", 0.35)
    return df.select("id", "line", "y", F.round(F.col("prediction") + 1.7e-7, 4).alias("prediction"))


_BINS = 8


@query("residual_shape", sql(
    f"SELECT feature, bin::INT AS bin, {r('lo + (bin + 0.5) * (hi - lo) / ' + str(_BINS), 'mid')}, {r('avg(e)', 'score')}, count(*) AS n FROM (SELECT feature, e, lo, hi, "
    f"least(floor((v - lo) / ((hi - lo) / {_BINS})), {_BINS - 1}) AS bin FROM u) GROUP BY feature, bin, lo, hi", "model_table",
    base=f"SELECT *, MAX_MEAN_DEPTH_1_8 - {_A} * 0.15 AS e FROM model_table",
    u=" UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS v, e, min({c}) OVER () AS lo, max({c}) OVER () AS hi FROM base" for c in (_A, "RES_MOD_AVG"))))
def _(t):
    df = t.model_table().withColumn("guess", F.col(_A) * 0.15)
    return rnd(additive.residual_shape(df, [_A, "RES_MOD_AVG"], "MAX_MEAN_DEPTH_1_8", "guess", _BINS))
