"""Cascade, completeness, filters on levels, schema-declared statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithosense.functions.times import day_of, week_of
from lithosense.operators import filters, gradients, health, rollup as R
from lithosense.operators.ingest import enrich_sensor
from lithosense.operators.sets import stack
from lithosense.plans import cascade as C
from lithosense.registry.base import AS_OF, MARK, THRESHOLD, columns, query, r, rnd, sql

SENSOR = C.rules_for("temperature", THRESHOLD)
TS = ("timestamp", "series_id", "mean", "min", "max", "std", "count")
DAY = ("date", "series_id", "mean", "min", "max", "std", "count", "temp_range")
WEEK = ("week_start", "week_end", "series_id", "mean", "min", "max", "std", "count", "temp_range")


def t15(t):
    return R.rollup_15min(t.readings(), threshold=THRESHOLD)


def th(t):
    return R.rollup_hourly(t15(t))


def td(t):
    return R.rollup_daily(th(t))


def z(t):
    """Sensor readings under the zero rule, by level."""
    rules = C.Rules("weather", None, "zero", "calendar")
    return C.cascade(t.readings().drop("event_id"), rules)


def w(t):
    return C.cascade(t.weather(), C.WEATHER)


@query("rollup_15min", sql(f"SELECT {columns(*TS)} FROM t15", "t15"))
def _(t):
    return rnd(t15(t))


@query("rollup_15min_dense", sql(f"SELECT {columns(*TS)} FROM d15", "dense", d15="""
    SELECT time_bucket(INTERVAL '15 minutes', "timestamp") AS "timestamp", series_id, avg(value) AS mean, min(value) AS min,
    max(value) AS max, stddev_samp(value) AS std, count(value) AS count FROM dense WHERE abs(value) > 1.0 GROUP BY 1, 2"""))
def _(t):
    return rnd(R.rollup_15min(t.dense(), threshold=THRESHOLD))


@query("rollup_15min_weather", sql(f"SELECT {columns(*TS)} FROM w15", "w15"))
def _(t):
    return rnd(R.rollup_15min_weather(t.weather()))


@query("rollup_15min_wide", sql(f"SELECT {columns(*TS)} FROM d15", "weather", d15="""
    SELECT time_bucket(INTERVAL '15 minutes', "timestamp") AS "timestamp", series_id, avg(value) AS mean, min(value) AS min,
    max(value) AS max, stddev_samp(value) AS std, count(value) AS count FROM weather WHERE abs(value) > 1.0 GROUP BY 1, 2"""))
def _(t):
    from lithosense.registry.base import METRIC_OF

    names = list(METRIC_OF.values())
    wide = t.weather().select("timestamp", *[F.when(F.col("series_id") == n, F.col("value")).alias(n) for n in names])
    return rnd(R.rollup_15min_wide(wide, names, threshold=THRESHOLD))


@query("rollup_hourly", sql(f"SELECT {columns(*TS)} FROM th", "th"))
def _(t):
    return rnd(th(t))


@query("rollup_hourly_weather", sql(f"SELECT {columns(*TS)} FROM wh", "wh"))
def _(t):
    return rnd(R.rollup_hourly(R.rollup_15min_weather(t.weather()), null_std="zero"))


@query("rollup_daily", sql(f"SELECT {columns(*DAY)} FROM td", "td"))
def _(t):
    return rnd(td(t))


@query("rollup_daily_weather", sql(f"SELECT {columns(*DAY)} FROM wd", "wd"))
def _(t):
    return rnd(w(t)["daily"])


def pd_(t):
    return R.rollup_daily(R.rollup_hourly(R.rollup_15min(t.packed(), threshold=THRESHOLD)))


@query("rollup_weekly", sql(f"SELECT {columns(*WEEK)} FROM pw", "pw"))
def _(t):
    return rnd(R.rollup_weekly(pd_(t)))


@query("rollup_weekly_weather", sql(f"SELECT {columns(*WEEK)} FROM ww", "ww"))
def _(t):
    return rnd(w(t)["weekly"])


@query("cascade", sql(f"SELECT {columns(*WEEK)} FROM zw", "zw"))
def _(t):
    return rnd(z(t)["weekly"])


@query("cascade_temperature", sql(f"SELECT {columns(*WEEK)} FROM pw", "pw"))
def _(t):
    return rnd(C.cascade(t.packed(), SENSOR)["weekly"])


@query("cascade_levels", sql(
    "SELECT '15min' AS level, count(*) AS rows, sum(count)::BIGINT AS readings FROM z15 UNION ALL SELECT 'hourly', count(*), sum(count)::BIGINT FROM zh "
    "UNION ALL SELECT 'daily', count(*), sum(count)::BIGINT FROM zd UNION ALL SELECT 'weekly', count(*), sum(count)::BIGINT FROM zw", "zw"))
def _(t):
    parts = [
        df.agg(F.lit(level).alias("level"), F.count(F.lit(1)).alias("rows"), F.sum("count").alias("readings"))
        for level, df in z(t).items()
    ]
    return stack(*parts)


@query("legacy_15min", sql(
    'SELECT time_bucket(INTERVAL \'15 minutes\', "timestamp") AS interval_start, series_id, depth, layer, '
    + r("avg(v)", "avg_temp") + ", min(v) AS min_temp, max(v) AS max_temp, count(v) AS count FROM e GROUP BY 1, 2, 3, 4", "readings", "dim",
    e='SELECT "timestamp", series_id, depth, layer, round(value, 2) AS v FROM readings JOIN dim ON series_id = sensor_id'))
def _(t):
    return rnd(R.legacy_15min(enrich_sensor(t.readings(), t.dim())))


@query("range_col", sql("SELECT \"timestamp\", series_id, " + r("max - min", "value_range") + " FROM t15", "t15"))
def _(t):
    from lithosense.functions.numeric import value_range

    return rnd(t15(t).select("timestamp", "series_id", value_range().alias("value_range")))


@query("pooled_std", sql('SELECT "timestamp", series_id, ' + r("std", "std") + ", count FROM zh", "zh"))
def _(t):
    return rnd(R.rollup_hourly(R.rollup_15min_weather(t.readings()), null_std="zero").select("timestamp", "series_id", "std", "count"))


@query("pooled_std_two_pass", sql('SELECT "timestamp", series_id, ' + r("std", "std") + ", count FROM th", "th"))
def _(t):
    from lithosense.functions.times import bucket_start

    finer = t15(t).select(bucket_start("timestamp", "1 hour").alias("timestamp"), "series_id", "mean", "std", "count")
    return rnd(R.pooled_std_two_pass(finer, ["timestamp", "series_id"]))


# Values far from zero with a small spread, as of air pressure in Pa.
_FAR = {"far": "SELECT \"timestamp\", series_id, 101325 + value / 40000 AS value FROM weather"}


@query("pooled_std_offset", sql(
    'SELECT k AS "timestamp", series_id, ' + r("CASE WHEN sum(count) = 1 THEN 0.0 ELSE sqrt(sum(count * (std * std + (mean - gm) * (mean - gm))) / sum(count)) END", "std")
    + """, sum(count)::BIGINT AS count FROM (SELECT *, date_trunc('hour', "timestamp") AS k, sum(count * mean) OVER w / sum(count) OVER w AS gm FROM f15
    WINDOW w AS (PARTITION BY date_trunc('hour', "timestamp"), series_id)) GROUP BY 1, 2""", "weather", **_FAR,
    f15="""SELECT time_bucket(INTERVAL '15 minutes', "timestamp") AS "timestamp", series_id, avg(value) AS mean, coalesce(stddev_samp(value), 0.0) AS std, count(value) AS count FROM far GROUP BY 1, 2"""))
def _(t):
    far = t.weather().withColumn("value", F.lit(101325) + F.col("value") / 40000)
    return rnd(R.rollup_hourly(R.rollup_15min_weather(far), null_std="zero").select("timestamp", "series_id", "std", "count"))


@query("exact_std_offset", sql(
    'SELECT CAST("timestamp" AS DATE) AS date, series_id, ' + r("stddev_samp(value)", "std") + ", count(*) AS count FROM far GROUP BY 1, 2", "weather", **_FAR))
def _(t):
    far = t.weather().withColumn("value", F.lit(101325) + F.col("value") / 40000)
    fine = R.rollup_15min(far, threshold=None).withColumn("date", day_of("timestamp"))
    return rnd(R.exact_rollup(fine, ["date", "series_id"]).select("date", "series_id", "std", "count"))


@query("exact_std", sql(
    'SELECT CAST("timestamp" AS DATE) AS date, series_id, ' + ", ".join([r("avg(value)", "mean"), r("min(value)", "min"), r("max(value)", "max"), r("stddev_samp(value)", "std")])
    + ", count(*) AS count FROM readings GROUP BY 1, 2", "readings"))
def _(t):
    fine = R.rollup_15min(t.readings(), threshold=None).withColumn("date", day_of("timestamp"))
    return rnd(R.exact_rollup(fine, ["date", "series_id"]))


@query("day_completeness", sql(
    'SELECT CAST("timestamp" AS DATE) AS date, series_id, count(DISTINCT "timestamp") AS hours FROM th GROUP BY 1, 2 HAVING count(DISTINCT "timestamp") >= 5', "th"))
def _(t):
    return R.day_completeness(th(t), required=5)


@query("week_completeness", sql(
    "SELECT CAST(date_trunc('week', date) AS DATE) AS week_start, series_id, count(DISTINCT date) AS days FROM td GROUP BY 1, 2 HAVING count(DISTINCT date) >= 7", "td"))
def _(t):
    return R.week_completeness(td(t), required=7)


# --- filters -----------------------------------------------------------------------
@query("active_filter", sql('SELECT event_id, "timestamp", series_id, value FROM readings WHERE abs(value) > 1.0', "readings"))
def _(t):
    return filters.active_filter(t.readings(), THRESHOLD)


@query("valid_stats", sql(f"SELECT {columns(*TS)} FROM t15 WHERE std IS NOT NULL AND count > 0", "t15"))
def _(t):
    return rnd(filters.valid_stats(t15(t), need_std=True))


@query("not_all_near_zero", sql(f"SELECT {columns(*TS)} FROM z15 WHERE abs(mean) > 1.0 OR abs(min) > 1.0 OR abs(max) > 1.0", "z15"))
def _(t):
    return rnd(filters.not_all_near_zero(R.rollup_15min_weather(t.readings()), THRESHOLD))


@query("closed_hours", sql(f"SELECT {columns(*TS)} FROM th WHERE \"timestamp\" + INTERVAL 1 HOUR <= TIMESTAMP '{AS_OF}'", "th"))
def _(t):
    return rnd(filters.closed_buckets(th(t), "hourly", AS_OF))


@query("closed_days", sql(f"SELECT {columns(*DAY)} FROM td WHERE CAST(date + 1 AS TIMESTAMP) <= TIMESTAMP '{AS_OF}'", "td"))
def _(t):
    return rnd(filters.closed_buckets(td(t), "daily", AS_OF))


@query("closed_weeks", sql(f"SELECT {columns(*WEEK)} FROM zw WHERE CAST(week_start + 7 AS TIMESTAMP) <= TIMESTAMP '{AS_OF}'", "zw"))
def _(t):
    return rnd(filters.closed_buckets(z(t)["weekly"], "weekly", AS_OF))


@query("since", sql(f"SELECT event_id, \"timestamp\", series_id, value FROM readings WHERE \"timestamp\" > TIMESTAMP '{MARK}'", "readings"))
def _(t):
    return filters.since(t.readings(), MARK)


@query("by_keys", sql(f"SELECT {columns(*DAY)} FROM td WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' AND series_id IN ('S1', 'S2', 'S3')", "td"))
def _(t):
    return rnd(filters.by_keys(td(t), "date", "2024-01-08", "2024-01-14", ["S1", "S2", "S3"]))


@query("by_keys_table", sql(
    f"SELECT {columns(*DAY)} FROM td WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' AND series_id IN (SELECT sensor_id FROM dim WHERE layer = 'BASE')", "td", "dim"))
def _(t):
    keys = t.dim().where(F.col("layer") == "BASE").select(F.col("sensor_id").alias("series_id"))
    return rnd(filters.by_keys(td(t), "date", "2024-01-08", "2024-01-14", keys))


@query("range_scan", sql("SELECT \"timestamp\", series_id, value FROM readings WHERE series_id = 'S3' AND \"timestamp\" BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12'", "readings"))
def _(t):
    return filters.range_scan(t.readings(), "S3", "2024-01-05", "2024-01-12")


@query("series_slice", sql(f"SELECT {columns('week_start', 'mean', 'min', 'max')} FROM zw WHERE series_id = 'S4'", "zw"))
def _(t):
    return rnd(filters.series_slice(z(t)["weekly"], "weekly", "S4"))


# --- schema-declared statistics ---------------------------------------------------------
def _extremes(bucket: str, name: str) -> str:
    return sql(
        f"SELECT {bucket} AS {name}, series_id, arg_min(\"timestamp\", (min, \"timestamp\")) AS min_timestamp, arg_min(\"timestamp\", (-max, \"timestamp\")) AS max_timestamp FROM th GROUP BY 1, 2", "th")


@query("extreme_times", _extremes('CAST("timestamp" AS DATE)', "date"))
def _(t):
    return gradients.extreme_times(th(t), day_of("timestamp"), "date")


@query("extreme_times_weekly", _extremes("CAST(date_trunc('week', \"timestamp\") AS DATE)", "week_start"))
def _(t):
    return gradients.extreme_times(th(t), week_of(day_of("timestamp")), "week_start")


_DND = """SELECT CAST("timestamp" AS DATE) AS date, series_id, avg(CASE WHEN hour("timestamp") BETWEEN 6 AND 17 THEN mean END)
    - avg(CASE WHEN NOT hour("timestamp") BETWEEN 6 AND 17 THEN mean END) AS day_night_delta FROM th GROUP BY 1, 2"""


@query("day_night_delta", sql(f"SELECT date, series_id, {r('day_night_delta', 'day_night_delta')} FROM dnd", "th", dnd=_DND))
def _(t):
    return rnd(gradients.day_night_delta(th(t)))


@query("weekday_weekend_avg", sql(
    "SELECT CAST(date_trunc('week', date) AS DATE) AS week_start, series_id, " + r("avg(CASE WHEN isodow(date) < 6 THEN mean END)", "weekday_avg") + ", "
    + r("avg(CASE WHEN isodow(date) >= 6 THEN mean END)", "weekend_avg") + " FROM td GROUP BY 1, 2", "td"))
def _(t):
    return rnd(gradients.weekday_weekend_avg(td(t)))


def _layers(src: str, axis: str) -> dict[str, str]:
    low = ("asphalt", "base", "subbase", "subgrade")
    parts = ", ".join(
        f"avg(CASE WHEN layer = '{n.upper()}' THEN mean END) AS {n}_mean, avg(CASE WHEN layer = '{n.upper()}' THEN depth END) AS {n}_depth" for n in low
    )
    grads = ", ".join(
        f"({a}_mean - {b}_mean) / nullif(({b}_depth - {a}_depth) / 1000, 0) AS {n}"
        for a, b, n in [(a, b, f"{a}_to_{b}") for a, b in zip(low, low[1:])] + [("asphalt", "subgrade", "surface_to_bottom")]
    )
    return {
        f"lw_{axis}": f"SELECT {axis}, {parts} FROM {src} JOIN shallow ON series_id = sensor_id GROUP BY 1",
        f"lg_{axis}": f"SELECT *, {grads} FROM lw_{axis}",
    }


_GRADS = ("asphalt_mean", "base_mean", "subbase_mean", "subgrade_mean", "asphalt_to_base", "base_to_subbase", "subbase_to_subgrade", "surface_to_bottom")
_BIGGEST = "arg_min({}, (-abs(surface_to_bottom), date))"
_MAXD = (
    f"SELECT CAST(date_trunc('week', date) AS DATE) AS week_start, {_BIGGEST.format('surface_to_bottom')} AS max_daily_gradient, "
    f"{_BIGGEST.format('date')} AS max_gradient_date FROM lg_date WHERE surface_to_bottom IS NOT NULL GROUP BY 1"
)
_DIU = (
    "SELECT CAST(date_trunc('week', date) AS DATE) AS week_start, avg(CASE WHEN layer = 'ASPHALT' THEN day_night_delta END) AS asphalt_diurnal, "
    "avg(CASE WHEN layer = 'BASE' THEN day_night_delta END) AS base_diurnal FROM dnd JOIN shallow ON series_id = sensor_id WHERE layer IN ('ASPHALT', 'BASE') GROUP BY 1"
)


@query("layer_gradient_weekly", sql(f"SELECT week_start, {', '.join(r(c, c) for c in _GRADS)} FROM lg_week_start", "zw", "shallow", **_layers("zw", "week_start")))
def _(t):
    return rnd(gradients.layer_gradient(z(t)["weekly"], t.shallow(), "week_start"))


@query("max_daily_gradient", sql(f"SELECT week_start, {r('max_daily_gradient', 'max_daily_gradient')}, max_gradient_date FROM maxd", "td", "shallow", **_layers("td", "date"), maxd=_MAXD))
def _(t):
    return rnd(gradients.max_daily_gradient(td(t), t.shallow()))


@query("diurnal_variation", sql(f"SELECT week_start, {r('asphalt_diurnal', 'asphalt_diurnal')}, {r('base_diurnal', 'base_diurnal')} FROM diu", "th", "shallow", dnd=_DND, diu=_DIU))
def _(t):
    return rnd(gradients.diurnal_variation(th(t), t.shallow()))


@query("gradient_weekly", sql(
    f"SELECT week_start, {', '.join(r(c, c) for c in (*_GRADS, 'max_daily_gradient', 'asphalt_diurnal', 'base_diurnal'))}, max_gradient_date, week_start + 6 AS interval_end "
    "FROM lg_week_start LEFT JOIN maxd USING (week_start) LEFT JOIN diu USING (week_start)", "zw", "shallow",
    **_layers("zw", "week_start"), **_layers("zd", "date"), maxd=_MAXD, dnd=_DND.replace("FROM th", "FROM zh"), diu=_DIU))
def _(t):
    levels = z(t)
    return rnd(gradients.gradient_weekly(levels["hourly"], levels["daily"], levels["weekly"], t.shallow()))


@query("sensor_health", sql("""SELECT date, series_id, round(coalesce(readings, 0) / 20.0::DOUBLE * 100 + 1.7e-9, 6) + 0.0 AS capture_rate, round(noise + 1.7e-9, 6) + 0.0 AS noise_level,
    coalesce(anomalies, 0)::BIGINT AS anomaly_count, NULL::DOUBLE AS battery_level, NULL::DOUBLE AS signal_strength,
    CASE WHEN readings IS NULL THEN 'OFFLINE' WHEN readings / 20.0 * 100 < 50 THEN 'CRITICAL' WHEN readings / 20.0 * 100 < 80 OR anomalies > 0 THEN 'WARNING' ELSE 'GOOD' END AS health_status
    FROM grid LEFT JOIN m USING (date, series_id)""", "t15", "dim",
    x="""SELECT CAST("timestamp" AS DATE) AS date, series_id, mean, std, count, avg(mean) OVER w AS c, stddev_pop(mean) OVER w AS sp FROM t15
    WINDOW w AS (PARTITION BY CAST("timestamp" AS DATE), series_id)""",
    m="SELECT date, series_id, sum(count) AS readings, avg(std) AS noise, count(*) FILTER (WHERE abs(mean - c) > 2.0 * sp) AS anomalies FROM x GROUP BY 1, 2",
    grid="""SELECT sensor_id AS series_id, CAST(unnest(generate_series((SELECT min(date) FROM x), (SELECT max(date) FROM x), INTERVAL 1 DAY)) AS DATE) AS date FROM dim WHERE is_active"""))
def _(t):
    return rnd(health.sensor_health(t15(t), t.dim(), expected_per_day=20, sigma=2.0, max_anomalies=0))


@query("interval_end", sql(f"SELECT {columns(*TS)}, \"timestamp\" + INTERVAL 15 MINUTE AS interval_end FROM t15", "t15"))
def _(t):
    return rnd(gradients.interval_end(t15(t), "15min"))


@query("raw_rollup_any", sql("""SELECT sensor_type, time_bucket(INTERVAL '15 minutes', ts) AS "timestamp", series_id, round(avg(value) + 1.7e-9, 6) + 0.0 AS mean, min(value) AS min, max(value) AS max,
    round(stddev_samp(value) + 1.7e-9, 6) + 0.0 AS std, count(*) AS count FROM (SELECT CASE event_type WHEN 'view' THEN 'STRAIN' WHEN 'click' THEN 'PRESSURE' ELSE 'MOISTURE' END AS sensor_type,
    ts, 'S' || (user_id % 5) AS series_id, value FROM events) GROUP BY 1, 2, 3"""))
def _(t):
    ev = t.events.select(F.col("ts").alias("timestamp"), F.concat(F.lit("S"), F.col("user_id") % 5).alias("series_id"), "value", "event_type")
    facts = {
        "STRAIN": ev.where(F.col("event_type") == "view"), "PRESSURE": ev.where(F.col("event_type") == "click"),
        "MOISTURE": ev.where(~F.col("event_type").isin("view", "click")),
    }
    tagged = stack(*[df.drop("event_type").withColumn("sensor_type", F.lit(k)) for k, df in facts.items()])
    return rnd(R.rollup_15min(tagged, keys=("sensor_type", "series_id"), threshold=None))
