"""Registration of runnable queries and the domain view of the generic test tables.

Each query is a function of ``Tables`` (a session and a folder of Parquet tables)
returning a DataFrame.  Most carry the equivalent SQL for an independent engine.
``CTES`` states, in that SQL, the same stand-ins that ``Tables`` builds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lithosense.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Threshold that plays the role of "near zero" on the test values (0.01 .. 490).
THRESHOLD = 1.0
AS_OF = "2024-01-20 10:20:00"
MARK = "2024-01-15 00:00:00"


def query(name: str, oracle: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(configure(spark), sf_dir))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


# Averages of two-decimal values are often exact decimal ties, which two engines
# may round differently after a last-bit difference; both sides move off the tie.
def _nudge(digits: int) -> float:
    return 1.7 * 10.0 ** -(digits + 3)


def rnd(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column, so that summation order does not show."""
    doubles = [f.name for f in df.schema if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(F.col(f"`{c}`") + F.lit(_nudge(digits)), digits) for c in doubles})


def r(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr} + {_nudge(digits)!r}, {digits}) + 0.0 AS {name}"


METRIC_OF = {
    "view": "temperature", "click": "solar_radiation", "error": "relative_humidity",
    "purchase": "wind_speed", "signup": "dew_point",
}
LAYER_OF = {"AFRICA": "ASPHALT", "AMERICA": "BASE", "ASIA": "SUBBASE", "EUROPE": "SUBGRADE", "MIDDLE EAST": "N/A"}
TYPE_OF = ("TEMPERATURE", "PRESSURE", "STRAIN", "MOISTURE", "WEATHER")


def _case(c: Column, mapping) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    # --- readings ---------------------------------------------------------------
    def readings(self) -> DataFrame:
        """25 sensors."""
        return self.events.select(
            F.col("ts").alias("timestamp"), F.concat(F.lit("S"), F.col("user_id") % 25).alias("series_id"), "value", "event_id"
        )

    def dense(self) -> DataFrame:
        """One series per event type."""
        return self.events.select(F.col("ts").alias("timestamp"), F.col("event_type").alias("series_id"), "value", "event_id")

    def packed(self, events: DataFrame | None = None) -> DataFrame:
        """Event time compressed fourfold, so that every quarter hour has many readings."""
        events = self.events if events is None else events
        start = F.lit("2024-01-01").cast("timestamp_ntz")
        micros = F.floor(F.timestamp_diff("MICROSECOND", start, F.col("ts")) / 4)
        return events.select(
            F.timestamp_add("MICROSECOND", micros, start).alias("timestamp"),
            F.when(F.col("user_id") % 10 == 0, "S1").otherwise("S0").alias("series_id"), "value", "event_id",
        )

    def weather(self) -> DataFrame:
        return self.events.select(
            F.col("ts").alias("timestamp"), _case(F.col("event_type"), METRIC_OF).alias("series_id"), "value", "event_id"
        )

    def dim(self) -> DataFrame:
        n = F.col("n_nationkey")
        kinds = {i: k for i, k in enumerate(TYPE_OF)}
        return self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.concat(F.lit("S"), n).alias("sensor_id"),
            _case(F.floor(n / 5), kinds).alias("sensor_type"),
            _case(F.col("r_name"), LAYER_OF).alias("layer"),
            (n * F.lit(30.0)).alias("depth"),
            (n % 7 != 0).alias("is_active"),
            F.lit("C").alias("units"),
        )

    def shallow(self) -> DataFrame:
        """The dimension with depth growing by layer, for gradients."""
        return self.dim().withColumn("depth", F.col("depth") % 150 + F.lit(40.0))

    # --- annual tables ------------------------------------------------------------
    def _co(self) -> DataFrame:
        o = self.orders.join(self.customer, F.col("o_custkey") == F.col("c_custkey"))
        return o.select(
            F.col("c_nationkey").alias("STATE_CODE"), F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("SHRP_ID"),
            F.year("o_orderdate").alias("YEAR"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("DAY_TEXT"),
            (F.col("o_orderkey") % 3 + 1).cast("int").alias("CONSTRUCTION_NO"),
            "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority",
        )

    def section_tables(self) -> dict[str, DataFrame]:
        co = self._co()
        key = ["STATE_CODE", "SHRP_ID", "YEAR"]
        price = F.col("o_totalprice")
        # every order counts in every table; keys without a partner come from shifted years
        yearly = lambda shift, *aggs: co.withColumn("YEAR", F.col("YEAR") + shift).groupBy(*key).agg(*aggs)
        some = (F.col("STATE_CODE") % 3 == 0).cast("int")
        precip = yearly(F.lit(0), F.round(F.avg(price) / 1000 + 1.7e-9, 6).alias("TOTAL_ANN_PRECIP"))
        temp = yearly(
            some,
            F.count(F.lit(1)).cast("double").alias("FREEZE_INDEX_YR"), F.round(F.avg(price) / 9000 + 1.7e-9, 6).alias("MEAN_ANN_TEMP_AVG"),
            (F.max(price) / 9000).alias("MAX_ANN_TEMP_AVG"), (F.min(price) / 9000).alias("MAX_ANN_TEMP_DAYS"),
            F.max(F.col("o_orderkey") % 60).cast("double").alias("DAYS_ABOVE_32_C_YR"),
        )
        kesal = F.round(F.sum(price) / 10000 + 1.7e-9, 4).alias("ANL_KESAL_LTPP_LN_YR")
        hist = yearly(some * 2, kesal, F.max("o_orderkey").cast("double").alias("AADT_ALL_VEHIC_2WAY"),
                      F.min("o_orderkey").cast("double").alias("AADT_TRUCK_COMBO_2WAY")).withColumnRenamed("YEAR", "YEAR_HIST_EST")
        mon = yearly(-some, kesal, F.max("o_orderkey").cast("double").alias("AADT_ALL_VEHIC"),
                     F.min("o_orderkey").cast("double").alias("AADT_TRUCK_COMBO")).withColumnRenamed("YEAR", "YEAR_MON_EST")
        survey = co.select(
            "STATE_CODE", "SHRP_ID", "CONSTRUCTION_NO", F.col("DAY_TEXT").alias("SURVEY_DATE"),
            (price / 20000).alias("MAX_MEAN_DEPTH_1_8"),
        )
        li = self.lineitem.join(co, F.col("l_orderkey") == F.col("o_orderkey")).join(self.part, F.col("l_partkey") == F.col("p_partkey"))
        material = F.when(F.col("p_type").isin("SMALL", "PROMO"), F.concat(F.lit("Fine-Grained Soils: "), F.col("p_brand"))).when(
            F.col("p_type") == "LARGE", F.lit(None).cast("string")).otherwise(F.concat(F.col("p_type"), F.lit(": "), F.col("p_brand")))
        tests = li.select(
            "STATE_CODE", "SHRP_ID", "CONSTRUCTION_NO", F.date_format("l_shipdate", "yyyy-MM-dd").alias("TEST_DATE"),
            F.col("l_linenumber").cast("int").alias("LAYER_TYPE"), F.col("l_extendedprice").alias("RES_MOD_AVG"),
            (F.col("l_suppkey") % 2 + 1).cast("int").alias("MR_MATL_TYPE"), F.col("p_type").alias("MR_MATL_TYPE_EXP"),
        )
        layers = li.groupBy("SHRP_ID", "STATE_CODE", "CONSTRUCTION_NO", F.col("l_linenumber").cast("int").alias("LAYER_NO"), material.alias("MATL_CODE_EXP")).agg(
            F.max("p_size").cast("double").alias("REPR_THICKNESS")
        )
        return {"precip": precip, "temp": temp, "traffic_hist": hist, "traffic_mon": mon, "section_survey": survey, "lab_test": tests, "layer_thickness": layers}

    def model_table(self) -> DataFrame:
        """Named model features from line items and parts; some thicknesses missing."""
        li = self.lineitem.join(self.part, F.col("l_partkey") == F.col("p_partkey"))
        d = lambda c: c.cast("double")
        return li.select(
            F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"),
            d(F.col("l_linenumber")).alias("CONSTRUCTION_NO"), d(F.col("l_quantity")).alias("ANL_KESAL_LTPP_LN_YR"),
            (F.col("l_discount") * 100).alias("TOTAL_ANN_PRECIP"), (F.col("l_tax") * 100).alias("FREEZE_INDEX_YR"),
            d(F.col("p_size")).alias("MAX_ANN_TEMP_AVG"), d(F.col("l_suppkey") % 30).alias("MAX_ANN_TEMP_DAYS"),
            d(F.col("l_partkey") % 50).alias("DAYS_ABOVE_32_C_YR"), d(F.col("l_orderkey") % 2 + 1).alias("MR_MATL_TYPE"),
            F.col("p_retailprice").alias("RES_MOD_AVG"),
            F.when(F.col("l_orderkey") % 10 != 0, d(F.col("l_quantity") % 7 + F.col("p_size"))).alias("REPR_THICKNESS"),
            (
                F.col("l_extendedprice") / 50000 + F.col("l_quantity") * 0.08 + (F.col("p_size") - 25) * (F.col("p_size") - 25) * F.lit(0.004)
                + F.col("l_discount") * F.col("p_size") * 0.5
            ).alias("MAX_MEAN_DEPTH_1_8"),
            F.when(F.col("l_orderkey") % 7 != 0, F.col("p_type")).alias("MATERIAL"),
        )

    def predictions(self) -> DataFrame:
        """A label with two predictions of different quality."""
        return self.lineitem.select(
            F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.col("l_extendedprice").alias("y"),
            (F.col("l_quantity") * 1500).alias("pred_a"), (F.col("l_extendedprice") * 0.5 + F.col("l_partkey") % 1000 * 40).alias("pred_b"),
        )


def _sql_case(expr: str, mapping) -> str:
    return f"CASE {expr} " + " ".join(f"WHEN {k!r} THEN '{v}'" for k, v in mapping.items()) + " END"


def _fifteen(src: str, threshold: float | None, zero: bool) -> str:
    std = "coalesce(stddev_samp(value), 0.0)" if zero else "stddev_samp(value)"
    where = "" if threshold is None else f"WHERE abs(value) > {threshold}"
    return (
        f"SELECT time_bucket(INTERVAL '15 minutes', \"timestamp\") AS \"timestamp\", series_id, avg(value) AS mean, min(value) AS min, "
        f"max(value) AS max, {std} AS std, count(value) AS count FROM {src} {where} GROUP BY 1, 2"
    )


def _pooled(src: str, bucket: str, name: str, zero: bool, extra: str = "") -> str:
    """Two-pass pooled statistics in SQL."""
    std = "sqrt(sum(count * s * s + count * (mean - gm) * (mean - gm)) / sum(count))"
    std = (
        f"CASE WHEN sum(count) = 1 THEN 0.0 ELSE {std} END" if zero
        else f"CASE WHEN count(std) < count(*) THEN NULL ELSE {std} END"
    )
    s = "coalesce(std, 0.0)" if zero else "std"
    return (
        f"SELECT k AS {name}, series_id, avg(mean) AS mean, min(min) AS min, max(max) AS max, {std} AS std, "
        f"sum(count)::BIGINT AS count{extra} FROM (SELECT *, {bucket} AS k, {s} AS s, "
        f"sum(count * mean) OVER w / sum(count) OVER w AS gm FROM {src} WINDOW w AS (PARTITION BY {bucket}, series_id)) GROUP BY 1, 2"
    )


_DAY, _WEEK = 'CAST("timestamp" AS DATE)', "CAST(date_trunc('week', date) AS DATE)"
_RANGE = ", max(max) - min(min) AS temp_range"

_SOME = "(STATE_CODE % 3 = 0)::INT"

# name -> (needs, SQL)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "readings": ((), "SELECT ts AS \"timestamp\", 'S' || (user_id % 25) AS series_id, value, event_id FROM events"),
    "dense": ((), 'SELECT ts AS "timestamp", event_type AS series_id, value, event_id FROM events'),
    "packed": (
        (),
        "SELECT make_timestamp(epoch_us(TIMESTAMP '2024-01-01') + (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 4) AS \"timestamp\", "
        "CASE WHEN user_id % 10 = 0 THEN 'S1' ELSE 'S0' END AS series_id, value, event_id FROM events",
    ),
    "p15": (("packed",), _fifteen("packed", THRESHOLD, False)),
    "ph": (("p15",), _pooled("p15", "date_trunc('hour', \"timestamp\")", '"timestamp"', False)),
    "pd": (("ph",), _pooled("ph", _DAY, "date", False, _RANGE)),
    "pw": (
        ("pd",),
        _pooled("(SELECT * FROM pd WHERE std IS NOT NULL)", _WEEK, "week_start", False, _RANGE + ", least(max(date), k + 6) AS week_end").replace(
            "GROUP BY 1, 2", "GROUP BY k, series_id"
        ),
    ),
    "weather": ((), f'SELECT ts AS "timestamp", {_sql_case("event_type", METRIC_OF)} AS series_id, value, event_id FROM events'),
    "dim": (
        (),
        f"SELECT 'S' || n_nationkey AS sensor_id, {_sql_case('n_nationkey // 5', dict(enumerate(TYPE_OF)))} AS sensor_type, "
        f"{_sql_case('r_name', LAYER_OF)} AS layer, n_nationkey * 30.0::DOUBLE AS depth, n_nationkey % 7 <> 0 AS is_active, 'C' AS units "
        "FROM nation JOIN region ON n_regionkey = r_regionkey",
    ),
    "shallow": (("dim",), "SELECT * REPLACE (depth % 150 + 40.0 AS depth) FROM dim"),
    "t15": (("readings",), _fifteen("readings", THRESHOLD, False)),
    "th": (("t15",), _pooled("t15", "date_trunc('hour', \"timestamp\")", '"timestamp"', False)),
    "td": (("th",), _pooled("th", _DAY, "date", False, _RANGE)),
    "tw": (
        ("td",),
        _pooled("(SELECT * FROM td WHERE std IS NOT NULL)", _WEEK, "week_start", False, _RANGE + ", least(max(date), k + 6) AS week_end").replace(
            "GROUP BY 1, 2", "GROUP BY k, series_id"
        ),
    ),
    # The same levels keeping buckets whose deviation is missing (zero rule on every step).
    "w15": (("weather",), _fifteen("weather", None, True)),
    "wh": (("w15",), _pooled("w15", "date_trunc('hour', \"timestamp\")", '"timestamp"', True)),
    "wd": (("wh",), _pooled("wh", _DAY, "date", True, _RANGE)),
    "ww": (("wd",), _pooled("wd", _WEEK, "week_start", True, _RANGE + ", k + 6 AS week_end").replace("GROUP BY 1, 2", "GROUP BY k, series_id")),
    "z15": (("readings",), _fifteen("readings", None, True)),
    "zh": (("z15",), _pooled("z15", "date_trunc('hour', \"timestamp\")", '"timestamp"', True)),
    "zd": (("zh",), _pooled("zh", _DAY, "date", True, _RANGE)),
    "zw": (("zd",), _pooled("zd", _WEEK, "week_start", True, _RANGE + ", k + 6 AS week_end").replace("GROUP BY 1, 2", "GROUP BY k, series_id")),
    "co": (
        (),
        "SELECT c_nationkey AS STATE_CODE, lpad(c_custkey::VARCHAR, 6, '0') AS SHRP_ID, year(o_orderdate)::INT AS YEAR, "
        "strftime(o_orderdate, '%Y-%m-%d') AS DAY_TEXT, (o_orderkey % 3 + 1)::INT AS CONSTRUCTION_NO, o_orderkey, o_totalprice, "
        "o_orderstatus, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey",
    ),
    "precip": (
        ("co",),
        "SELECT STATE_CODE, SHRP_ID, YEAR, round(avg(o_totalprice) / 1000 + 1.7e-9, 6) AS TOTAL_ANN_PRECIP FROM co GROUP BY 1, 2, 3",
    ),
    "temp": (
        ("co",),
        f"SELECT STATE_CODE, SHRP_ID, YEAR + {_SOME} AS YEAR, count(*)::DOUBLE AS FREEZE_INDEX_YR, round(avg(o_totalprice) / 9000 + 1.7e-9, 6) AS MEAN_ANN_TEMP_AVG, "
        "max(o_totalprice) / 9000 AS MAX_ANN_TEMP_AVG, min(o_totalprice) / 9000 AS MAX_ANN_TEMP_DAYS, "
        "max(o_orderkey % 60)::DOUBLE AS DAYS_ABOVE_32_C_YR FROM co GROUP BY 1, 2, 3",
    ),
    "traffic_hist": (
        ("co",),
        f"SELECT STATE_CODE, SHRP_ID, YEAR + 2 * {_SOME} AS YEAR, round(sum(o_totalprice) / 10000 + 1.7e-9, 4) AS ANL_KESAL_LTPP_LN_YR, max(o_orderkey)::DOUBLE AS AADT_ALL_VEHIC_2WAY, "
        "min(o_orderkey)::DOUBLE AS AADT_TRUCK_COMBO_2WAY FROM co GROUP BY 1, 2, 3",
    ),
    "traffic_mon": (
        ("co",),
        f"SELECT STATE_CODE, SHRP_ID, YEAR - {_SOME} AS YEAR, round(sum(o_totalprice) / 10000 + 1.7e-9, 4) AS ANL_KESAL_LTPP_LN_YR, max(o_orderkey)::DOUBLE AS AADT_ALL_VEHIC, "
        "min(o_orderkey)::DOUBLE AS AADT_TRUCK_COMBO FROM co GROUP BY 1, 2, 3",
    ),
    "traffic": (("traffic_hist", "traffic_mon"), "SELECT * FROM traffic_hist UNION ALL BY NAME SELECT * FROM traffic_mon"),
    "section_survey": (
        ("co",),
        "SELECT STATE_CODE, SHRP_ID, CONSTRUCTION_NO, DAY_TEXT AS SURVEY_DATE, o_totalprice / 20000 AS MAX_MEAN_DEPTH_1_8, YEAR FROM co",
    ),
    "li": (("co",), "SELECT * FROM lineitem JOIN co ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"),
    "lab_test": (
        ("li",),
        "SELECT STATE_CODE, SHRP_ID, CONSTRUCTION_NO, strftime(l_shipdate, '%Y-%m-%d') AS TEST_DATE, l_linenumber::INT AS LAYER_TYPE, "
        "l_extendedprice AS RES_MOD_AVG, (l_suppkey % 2 + 1)::INT AS MR_MATL_TYPE, p_type AS MR_MATL_TYPE_EXP, year(l_shipdate)::INT AS YEAR FROM li",
    ),
    "layer_thickness": (
        ("li",),
        "SELECT SHRP_ID, STATE_CODE, CONSTRUCTION_NO, l_linenumber::INT AS LAYER_NO, CASE WHEN p_type IN ('SMALL', 'PROMO') THEN 'Fine-Grained Soils: ' || p_brand "
        "WHEN p_type = 'LARGE' THEN NULL ELSE p_type || ': ' || p_brand END AS MATL_CODE_EXP, max(p_size)::DOUBLE AS REPR_THICKNESS FROM li GROUP BY 1, 2, 3, 4, 5",
    ),
    "first_layers": (
        ("layer_thickness",),
        "SELECT *, CASE WHEN MATL_CODE_EXP IS NULL OR MATL_CODE_EXP LIKE 'Fine-%' THEN 2 ELSE 1 END AS MR_MATL_TYPE FROM layer_thickness WHERE LAYER_NO = 1",
    ),
    "climate": (("precip", "temp"), "SELECT * FROM precip FULL JOIN temp USING (STATE_CODE, SHRP_ID, YEAR)"),
    "traffic_section": (("traffic", "section_survey"), "SELECT * FROM traffic JOIN section_survey USING (STATE_CODE, SHRP_ID, YEAR)"),
    "climate_section": (("traffic_section", "climate"), "SELECT * FROM traffic_section JOIN climate USING (STATE_CODE, SHRP_ID, YEAR)"),
    "tested": (
        ("climate_section", "lab_test"),
        "SELECT * FROM climate_section JOIN (SELECT * FROM lab_test WHERE LAYER_TYPE = 1) USING (STATE_CODE, SHRP_ID, YEAR, CONSTRUCTION_NO)",
    ),
    "model_table": (
        (),
        "SELECT l_orderkey AS id, l_linenumber AS line, l_linenumber::DOUBLE AS CONSTRUCTION_NO, l_quantity::DOUBLE AS ANL_KESAL_LTPP_LN_YR, l_discount * 100 AS TOTAL_ANN_PRECIP, "
        "l_tax * 100 AS FREEZE_INDEX_YR, p_size::DOUBLE AS MAX_ANN_TEMP_AVG, (l_suppkey % 30)::DOUBLE AS MAX_ANN_TEMP_DAYS, (l_partkey % 50)::DOUBLE AS DAYS_ABOVE_32_C_YR, "
        "(l_orderkey % 2 + 1)::DOUBLE AS MR_MATL_TYPE, p_retailprice AS RES_MOD_AVG, CASE WHEN l_orderkey % 10 <> 0 THEN (l_quantity % 7 + p_size)::DOUBLE END AS REPR_THICKNESS, "
        "l_extendedprice / 50000 + l_quantity * 0.08::DOUBLE + (p_size - 25) * (p_size - 25) * 0.004::DOUBLE + l_discount * p_size * 0.5::DOUBLE AS MAX_MEAN_DEPTH_1_8, CASE WHEN l_orderkey % 7 <> 0 THEN p_type END AS MATERIAL FROM lineitem JOIN part ON l_partkey = p_partkey",
    ),
    "predictions": (
        (),
        "SELECT l_orderkey AS id, l_linenumber AS line, l_extendedprice AS y, l_quantity * 1500 AS pred_a, l_extendedprice * 0.5 + l_partkey % 1000 * 40 AS pred_b FROM lineitem",
    ),
}


def sql(body: str, *needs: str, **extra: str) -> str:
    """``WITH`` the named stand-ins (and what they need) and ``extra`` CTEs, then ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n not in order:
            for d in CTES[n][0]:
                visit(d)
            order.append(n)

    for n in needs:
        visit(n)
    parts = [f"{n} AS ({CTES[n][1]})" for n in order] + [f"{n} AS ({q})" for n, q in extra.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def columns(*names: str, digits: int = 6, rounded: tuple[str, ...] = ("mean", "min", "max", "std", "temp_range")) -> str:
    """SELECT list with the statistics rounded."""
    return ", ".join(r(n, n, digits) if n in rounded else f'"{n}"' for n in names)
