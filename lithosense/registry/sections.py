"""Section-year joins and the modelling table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithosense.operators.joins import merge
from lithosense.plans import section_table as S
from lithosense.registry.base import query, sql

KEYS = "STATE_CODE, SHRP_ID, YEAR"


def _traffic_section(tables):
    return S.join_traffic_section(S.union_traffic(tables["traffic_hist"], tables["traffic_mon"]), tables["section_survey"])


def _tested(tables):
    return S.join_tests(S.climate_traffic_table(tables), tables["lab_test"])


@query("join_climate", sql("SELECT * FROM climate", "climate"))
def _(t):
    x = t.section_tables()
    return S.join_climate(x["precip"], x["temp"])


@query("join_traffic_outer", sql(
    f"SELECT {KEYS}, h.ANL_KESAL_LTPP_LN_YR AS ANL_KESAL_LTPP_LN_YR_x, AADT_ALL_VEHIC_2WAY, AADT_TRUCK_COMBO_2WAY, m.ANL_KESAL_LTPP_LN_YR AS ANL_KESAL_LTPP_LN_YR_y, AADT_ALL_VEHIC, AADT_TRUCK_COMBO "
    f"FROM traffic_hist h FULL JOIN traffic_mon m USING ({KEYS})", "traffic"))
def _(t):
    x = t.section_tables()
    return S.join_traffic_outer(x["traffic_hist"], x["traffic_mon"])


@query("union_traffic", sql("SELECT * FROM traffic", "traffic"))
def _(t):
    x = t.section_tables()
    return S.union_traffic(x["traffic_hist"], x["traffic_mon"])


@query("join_traffic_section", sql("SELECT * FROM traffic_section", "traffic_section"))
def _(t):
    return _traffic_section(t.section_tables())


@query("join_climate_section", sql("SELECT * FROM climate_section", "climate_section"))
def _(t):
    return S.climate_traffic_table(t.section_tables())


@query("join_tests", sql("SELECT * FROM tested", "tested"))
def _(t):
    return _tested(t.section_tables())


@query("join_layers", sql(
    f"SELECT {KEYS}, CONSTRUCTION_NO, MR_MATL_TYPE, RES_MOD_AVG, MAX_MEAN_DEPTH_1_8, LAYER_NO, MATL_CODE_EXP, REPR_THICKNESS FROM tested LEFT JOIN first_layers USING (SHRP_ID, STATE_CODE, CONSTRUCTION_NO, MR_MATL_TYPE)", "tested", "first_layers"))
def _(t):
    x = t.section_tables()
    return S.join_layers(_tested(x), S.first_layers(x["layer_thickness"])).select(
        "STATE_CODE", "SHRP_ID", "YEAR", "CONSTRUCTION_NO", "MR_MATL_TYPE", "RES_MOD_AVG", "MAX_MEAN_DEPTH_1_8", "LAYER_NO", "MATL_CODE_EXP", "REPR_THICKNESS"
    )


@query("material_code", sql("SELECT SHRP_ID, CONSTRUCTION_NO, MATL_CODE_EXP, MR_MATL_TYPE, split_part(MATL_CODE_EXP, ': ', 1) AS MATL_KIND FROM first_layers", "first_layers"))
def _(t):
    return S.first_layers(t.section_tables()["layer_thickness"]).select("SHRP_ID", "CONSTRUCTION_NO", "MATL_CODE_EXP", "MR_MATL_TYPE", "MATL_KIND")


@query("drop_index_cols", sql("SELECT p_partkey, p_size FROM part"))
def _(t):
    return S.drop_index_cols(t.part.select(F.lit(0).alias("Unnamed: 0"), "p_partkey", "p_size", F.lit(1).alias("Unnamed: 0.1")))


_FINAL = "STATE_CODE, SHRP_ID, YEAR, CONSTRUCTION_NO, MAX_MEAN_DEPTH_1_8, ANL_KESAL_LTPP_LN_YR, TOTAL_ANN_PRECIP, FREEZE_INDEX_YR, MAX_ANN_TEMP_AVG, MAX_ANN_TEMP_DAYS, DAYS_ABOVE_32_C_YR, MR_MATL_TYPE, RES_MOD_AVG, REPR_THICKNESS"


@query("build_section_table", sql(f"SELECT {_FINAL} FROM tested LEFT JOIN first_layers USING (SHRP_ID, STATE_CODE, CONSTRUCTION_NO, MR_MATL_TYPE)", "tested", "first_layers"))
def _(t):
    return S.build_section_table(t.section_tables())


@query("climate_traffic_report", sql(
    "SELECT DISTINCT STATE_CODE, SHRP_ID, YEAR, CONSTRUCTION_NO, MAX_MEAN_DEPTH_1_8, ANL_KESAL_LTPP_LN_YR, TOTAL_ANN_PRECIP, FREEZE_INDEX_YR, MAX_ANN_TEMP_AVG, MAX_ANN_TEMP_DAYS, DAYS_ABOVE_32_C_YR, "
    "AADT_ALL_VEHIC_2WAY, AADT_TRUCK_COMBO_2WAY, AADT_ALL_VEHIC, AADT_TRUCK_COMBO FROM climate_section", "climate_section"))
def _(t):
    return S.climate_traffic_report(t.section_tables())


@query("merge_null_keys", sql("""SELECT a.k, a.n AS n_x, b.n AS n_y FROM (SELECT MATERIAL AS k, count(*) AS n FROM model_table WHERE line < 4 GROUP BY 1) a
    FULL JOIN (SELECT MATERIAL AS k, count(*) AS n FROM model_table WHERE line >= 4 GROUP BY 1) b ON a.k IS NOT DISTINCT FROM b.k""", "model_table"))
def _(t):
    m = t.model_table().select(F.col("MATERIAL").alias("k"), "line")
    a = m.where("line < 4").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    b = m.where("line >= 4").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return merge(a, b, ["k"], "outer", null_safe=True)
