"""Views, windows, summaries, joins on readings, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithosense.constants import FEATURES, TARGET
from lithosense.functions import numeric, text, times
from lithosense.operators import filters, joins, sets, sketches, summaries
from lithosense.operators.quantiles import describe, group_quantiles, percentiles
from lithosense.operators.windows import dedup_first, dedup_rows, latest_per_series, rate_of_change
from lithosense.plans import views
from lithosense.registry.base import columns, query, r, rnd, sql
from lithosense.registry.rollups import TS, th, w, z

# --- windows ---------------------------------------------------------------------------
_LAG = 'lag({}) OVER (PARTITION BY series_id ORDER BY "timestamp", event_id)'
_SECONDS = f'(epoch_us("timestamp") - epoch_us({_LAG.format(chr(34) + "timestamp" + chr(34))})) / 1000000.0::DOUBLE'


@query("lag_change", sql(f"SELECT event_id, {r('value - ' + _LAG.format('value'), 'temp_change')} FROM readings", "readings"))
def _(t):
    return rnd(rate_of_change(t.readings(), tiebreak=("event_id",)).select("event_id", "temp_change"))


@query("seconds_since_prev", sql(f"SELECT event_id, {r(_SECONDS, 'seconds_diff')} FROM readings", "readings"))
def _(t):
    return rnd(rate_of_change(t.readings(), slices=("1 day", "30 days")).select("event_id", "seconds_diff"))


@query("rate_per_hour", sql(
    f"SELECT event_id, \"timestamp\", series_id, value, {r('c', 'temp_change')}, {r('s', 'seconds_diff')}, {r('c / nullif(s, 0) * 3600', 'change_per_hour', 2)} FROM x", "dense",
    x=f"SELECT *, value - {_LAG.format('value')} AS c, {_SECONDS} AS s FROM dense"))
def _(t):
    df = rate_of_change(t.dense(), tiebreak=("event_id",))
    six = [F.round(F.col(c) + 1.7e-9, 6).alias(c) for c in ("temp_change", "seconds_diff")]
    # Rates reach 1e8, where only two decimals are meaningful.
    return df.select("event_id", "timestamp", "series_id", "value", *six, F.round(F.col("change_per_hour") + 1.7e-5, 2).alias("change_per_hour"))


@query("latest_per_series", sql('SELECT series_id, arg_max(value, "timestamp") AS latest_value, max("timestamp") AS latest_timestamp FROM readings GROUP BY 1', "readings"))
def _(t):
    return latest_per_series(t.readings())


@query("dedup_first", sql("""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1"""))
def _(t):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    out = dedup_first(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])
    return out.drop("l_suppkey", "l_shipdate")


@query("dedup_rows", sql("SELECT DISTINCT event_type, user_id, CASE WHEN user_id % 5 > 0 THEN CAST(ts AS DATE) END AS day FROM events"))
def _(t):
    return dedup_rows(t.events.select("event_type", "user_id", F.when(F.col("user_id") % 5 > 0, F.col("ts").cast("date")).alias("day")))


# --- summaries --------------------------------------------------------------------------
@query("weekly_summary", sql(
    "SELECT week_start, " + ", ".join(r(f"avg({a})", n) for a, n in (("mean", "avg_mean"), ("min", "avg_min"), ("max", "avg_max"), ("temp_range", "avg_range")))
    + ", sum(count)::BIGINT AS total_readings FROM zw GROUP BY 1", "zw"))
def _(t):
    return rnd(summaries.weekly_summary(z(t)["weekly"]))


@query("layer_stats", sql("SELECT week_start, layer, " + ", ".join(r(f"avg({c})", c) for c in ("mean", "min", "max")) + " FROM zw JOIN dim ON series_id = sensor_id GROUP BY 1, 2", "zw", "dim"))
def _(t):
    return rnd(summaries.layer_stats(z(t)["weekly"], t.dim()))


@query("distinct_values", sql("SELECT DISTINCT p_type FROM part"))
def _(t):
    return sets.distinct_values(t.part, "p_type")


@query("null_counts", sql("SELECT 'REPR_THICKNESS' AS \"column\", count(*) FILTER (WHERE REPR_THICKNESS IS NULL) AS missing FROM model_table UNION ALL "
    "SELECT 'MATERIAL', count(*) FILTER (WHERE MATERIAL IS NULL) FROM model_table UNION ALL SELECT 'id', 0", "model_table"))
def _(t):
    return summaries.null_counts(t.model_table().select("REPR_THICKNESS", "MATERIAL", "id"))


@query("describe", sql("SELECT count(value) AS count, " + ", ".join([
    r("avg(value)", "mean"), r("stddev_samp(value)", "std"), r("min(value)", "min"), r("quantile_cont(value, 0.25)", "p25"),
    r("quantile_cont(value, 0.5)", "p50"), r("quantile_cont(value, 0.75)", "p75"), r("max(value)", "max")]) + " FROM events"))
def _(t):
    return rnd(describe(t.events, "value"))


_COR = (*FEATURES, TARGET)


@query("corr_matrix", sql(" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})', 'r')} FROM model_table" for i, a in enumerate(_COR) for b in _COR[i + 1:]), "model_table"))
def _(t):
    return rnd(summaries.corr_matrix(t.model_table(), list(_COR)))


@query("group_mean", sql("SELECT MR_MATL_TYPE, " + ", ".join(r(f"avg({c})", c) for c in ("RES_MOD_AVG", "REPR_THICKNESS")) + " FROM model_table GROUP BY 1", "model_table"))
def _(t):
    return rnd(summaries.group_mean(t.model_table(), ["MR_MATL_TYPE"], ["RES_MOD_AVG", "REPR_THICKNESS"]))


@query("pivot_layers", sql(
    'SELECT "timestamp", ' + ", ".join(r(f"max(CASE WHEN layer = '{n.upper()}' THEN mean END)", f"{n}_temp") for n in ("asphalt", "base", "subbase", "subgrade"))
    + " FROM zh JOIN dim ON series_id = sensor_id GROUP BY 1", "zh", "dim"))
def _(t):
    return rnd(summaries.pivot_layers(z(t)["hourly"], t.dim()))


@query("latest_ts", sql('SELECT event_id, "timestamp" FROM readings WHERE "timestamp" = (SELECT max("timestamp") FROM readings)', "readings"))
def _(t):
    src = t.readings().select("event_id", "timestamp")
    return src.where(F.col("timestamp") == summaries.latest(src))


@query("percentiles", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {p}::DOUBLE AS p, {r(f'quantile_cont({c}, {p})', 'value')} FROM lineitem" for c in ("l_quantity", "l_extendedprice") for p in (0.05, 0.5, 0.95))))
def _(t):
    return rnd(percentiles(t.lineitem, ["l_quantity", "l_extendedprice"], [0.05, 0.5, 0.95]))


@query("percentiles_by_day", sql("SELECT CAST(\"timestamp\" AS DATE) AS date, series_id, count(*) AS n, " + ", ".join(
    r(f"quantile_cont(value, {p})", f"p{round(p * 100)}") for p in (0.05, 0.5, 0.95)) + " FROM readings GROUP BY 1, 2", "readings"))
def _(t):
    """Three quantiles of every sensor and day."""
    rows = t.readings().select(F.col("timestamp").cast("date").alias("date"), "series_id", "value")
    return rnd(group_quantiles(rows, ["date", "series_id"], "value", [0.05, 0.5, 0.95]))


@query("distinct_sketches", sql("SELECT CAST(date_trunc('week', \"timestamp\") AS DATE) AS week_start, series_id, count(*) AS n, count(DISTINCT round(value)) AS \"distinct\" FROM readings GROUP BY 1, 2", "readings"))
def _(t):
    """Distinct whole values a week, from sketches of hours merged into days and weeks."""
    hours = sketches.hourly_sketches(t.readings().withColumn("value", F.round("value").cast("bigint")), "value")
    return sketches.with_estimate(sketches.weekly_sketches(sketches.daily_sketches(hours)))


@query("percentiles_narrowed", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {p}::DOUBLE AS p, {r(f'quantile_cont({c}, {p})', 'value')} FROM lineitem" for c in ("l_quantity", "l_extendedprice") for p in (0.25, 0.5, 0.75))))
def _(t):
    """The bracket search itself, forced by a small bracket size."""
    return rnd(percentiles(t.lineitem, ["l_quantity", "l_extendedprice"], [0.25, 0.5, 0.75], limit=200))


# --- views --------------------------------------------------------------------------------
@query("daily_sensor_vs_weather", sql(
    "SELECT day, " + ", ".join([r("avg(m)", "avg_sensor_temp"), r("max(CASE WHEN metric = 'temperature' THEN wm END)", "max_air_temp"),
    r("max(CASE WHEN metric = 'solar_radiation' THEN wm END)", "max_solar_radiation")]) + " FROM j GROUP BY 1", "zh", "wh", "dim",
    j="""SELECT CAST(a."timestamp" AS DATE) AS day, a.mean AS m, b.series_id AS metric, b.mean AS wm FROM zh a JOIN dim ON a.series_id = sensor_id
    JOIN wh b ON date_trunc('day', a."timestamp") = date_trunc('day', b."timestamp") WHERE layer = 'ASPHALT' AND depth < 400
    AND a."timestamp" BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-25' AND b.series_id IN ('temperature', 'solar_radiation')"""))
def _(t):
    return rnd(views.daily_sensor_vs_weather(z(t)["hourly"], t.dim(), w(t)["hourly"], "2024-01-02", "2024-01-25", max_depth=400))


@query("join_dim", sql("SELECT \"timestamp\", series_id, value, layer, depth FROM readings JOIN dim ON series_id = sensor_id WHERE is_active AND depth < 100", "readings", "dim"))
def _(t):
    dim = t.dim().where(F.col("is_active") & (F.col("depth") < 100)).select("sensor_id", "layer", "depth")
    return joins.join_dim(t.readings().drop("event_id"), dim)


@query("latest_readings_view", sql("""SELECT sensor_id, sensor_type, layer, depth, latest_value, latest_timestamp, units FROM dim
    LEFT JOIN (SELECT kind, series_id, arg_max(value, (ts, event_id)) AS latest_value, max(ts) AS latest_timestamp FROM f GROUP BY 1, 2) ON kind = sensor_type AND series_id = sensor_id
    WHERE is_active""", "dim", f="""SELECT CASE event_type WHEN 'view' THEN 'TEMPERATURE' WHEN 'click' THEN 'PRESSURE' WHEN 'error' THEN 'STRAIN' ELSE 'MOISTURE' END AS kind,
    'S' || (user_id % 30) AS series_id, ts, value, event_id FROM events"""))
def _(t):
    """All events are facts; some series are no sensors, and some sensors have no facts."""
    ev = t.events.select(F.concat(F.lit("S"), F.col("user_id") % 30).alias("series_id"), F.col("ts").alias("timestamp"), "value", F.col("event_id").alias("reading_id"), "event_type")
    of = lambda *k: ev.where(F.col("event_type").isin(*k))
    facts = {"TEMPERATURE": of("view"), "PRESSURE": of("click"), "STRAIN": of("error"), "MOISTURE": of("signup", "purchase")}
    return views.latest_readings(t.dim(), facts)


@query("current_profile", sql(
    f"SELECT depth, layer, {r('mean', 'temperature')}, \"timestamp\" FROM zh JOIN dim ON series_id = sensor_id WHERE sensor_type = 'TEMPERATURE' AND \"timestamp\" = (SELECT max(\"timestamp\") FROM zh)", "zh", "dim"))
def _(t):
    return rnd(views.current_profile(z(t)["hourly"], t.dim()))


@query("current_weather", sql(f"SELECT series_id AS metric_name, {columns('mean', 'min', 'max', 'timestamp')} FROM wh WHERE \"timestamp\" = (SELECT max(\"timestamp\") FROM wh)", "wh"))
def _(t):
    return rnd(views.current_weather(w(t)["hourly"]))


@query("weekly_temp_weather", sql(
    "SELECT week_start, a.week_end, a.series_id AS sensor_id, layer, depth, " + ", ".join([
        r("a.mean", "avg_temperature"), r("a.min", "min_temperature"), r("a.max", "max_temperature"), r("air", "avg_air_temperature"),
        r("humid", "avg_humidity"), r("sun", "avg_solar_radiation")])
    + " FROM zw a JOIN dim ON a.series_id = sensor_id LEFT JOIN station USING (week_start)", "zw", "ww", "dim",
    station="""SELECT week_start, max(mean) FILTER (series_id = 'temperature') AS air, max(mean) FILTER (series_id = 'relative_humidity') AS humid,
    max(mean) FILTER (series_id = 'solar_radiation') AS sun FROM ww GROUP BY 1"""))
def _(t):
    return rnd(views.weekly_temp_weather(z(t)["weekly"], w(t)["weekly"], t.dim()))


@query("join_on_day", sql("""SELECT a.day, a.n AS sensors, b.metric, round(b.mean + 1.7e-9, 6) + 0.0 AS mean FROM (SELECT CAST("timestamp" AS DATE) AS day, count(*) AS n FROM zh GROUP BY 1) a
    JOIN (SELECT CAST("timestamp" AS DATE) AS day, series_id AS metric, avg(mean) AS mean FROM wh GROUP BY 1, 2) b USING (day)""", "zh", "wh"))
def _(t):
    a = z(t)["hourly"].groupBy(F.col("timestamp").cast("date").alias("d1")).agg(F.count(F.lit(1)).alias("sensors"))
    b = w(t)["hourly"].groupBy(F.col("timestamp").cast("date").alias("d2"), F.col("series_id").alias("metric")).agg(F.avg("mean").alias("mean"))
    return rnd(joins.join_on_day(a, b, "d1", "d2").drop("d1", "d2"))


@query("semi_dates", sql(f"SELECT {columns(*TS)} FROM wh WHERE CAST(\"timestamp\" AS DATE) IN (SELECT date FROM (SELECT CAST(\"timestamp\" AS DATE) AS date, series_id FROM th GROUP BY 1, 2 HAVING count(DISTINCT \"timestamp\") >= 9) GROUP BY 1 HAVING count(*) >= 8)", "wh", "th"))
def _(t):
    """Station hours on days when at least eight sensors were complete."""
    from lithosense.operators.rollup import day_completeness

    complete = day_completeness(th(t), 9).groupBy("date").agg(F.count(F.lit(1)).alias("sensors")).where("sensors >= 8")
    weather = w(t)["hourly"].withColumn("date", F.col("timestamp").cast("date"))
    return rnd(joins.semi_dates(weather, complete, ["date"]).drop("date"))


@query("anti_existing", sql(f"SELECT {columns('week_start', 'series_id', 'mean')} FROM zw WHERE (week_start, series_id) NOT IN (SELECT week_start, series_id FROM zw WHERE week_start < DATE '2024-01-15' OR series_id = 'S2')", "zw"))
def _(t):
    weekly = z(t)["weekly"].select("week_start", "series_id", "mean")
    stored = weekly.where((F.col("week_start") < "2024-01-15") | (F.col("series_id") == "S2"))
    return rnd(joins.anti_existing(weekly, stored, ["week_start", "series_id"]))


@query("group_mean_fallback", sql(f"""SELECT m.id, m.line, m.RES_MOD_AVG AS price, MR_MATL_TYPE, {r('coalesce(m.REPR_THICKNESS, g.a)', 'REPR_THICKNESS')} FROM model_table m
    LEFT JOIN (SELECT MR_MATL_TYPE, avg(REPR_THICKNESS) AS a FROM model_table GROUP BY 1) g USING (MR_MATL_TYPE)""", "model_table"))
def _(t):
    m = t.model_table().select("id", "line", F.col("RES_MOD_AVG").alias("price"), "MR_MATL_TYPE", "REPR_THICKNESS")
    return rnd(joins.group_mean_fallback(m, m, "MR_MATL_TYPE", ["REPR_THICKNESS"]))


# --- filters on tables --------------------------------------------------------------------
@query("eq_filters", sql("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '2-HIGH'"))
def _(t):
    return filters.eq_filters(t.orders, o_orderstatus="O", o_orderpriority="2-HIGH").select("o_orderkey", "o_totalprice")


@query("sql_predicates", sql("SELECT sensor_id, depth FROM dim WHERE is_active AND depth < 400 AND layer IN ('ASPHALT', 'BASE')", "dim"))
def _(t):
    return t.spark.sql("SELECT sensor_id, depth FROM {dim} WHERE is_active AND depth < 400 AND layer IN ('ASPHALT', 'BASE')", dim=t.dim())


@query("project", sql("SELECT l_orderkey AS id, l_extendedprice AS price, l_returnflag FROM lineitem"))
def _(t):
    return filters.project(t.lineitem, ["l_orderkey", "l_extendedprice", "l_returnflag"], {"l_orderkey": "id", "l_extendedprice": "price"})


@query("check_constraints", sql("""SELECT 'enum:layer' AS rule, count(*) FILTER (WHERE layer IS NOT NULL AND layer NOT IN ('ASPHALT', 'BASE', 'SUBBASE', 'SUBGRADE', 'AIR', 'N/A')) AS violations FROM d
    UNION ALL SELECT 'enum:sensor_type', count(*) FILTER (WHERE sensor_type NOT IN ('TEMPERATURE', 'STRAIN', 'PRESSURE', 'MOISTURE', 'WEATHER')) FROM d
    UNION ALL SELECT 'required:depth', count(*) FILTER (WHERE depth IS NULL) FROM d
    UNION ALL SELECT 'unique:order,line', (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))""", "dim",
    d="SELECT CASE WHEN sensor_id = 'S3' THEN 'ROCK' ELSE layer END AS layer, sensor_type, CASE WHEN is_active THEN depth END AS depth FROM dim"))
def _(t):
    d = t.dim().select(F.when(F.col("sensor_id") == "S3", "ROCK").otherwise(F.col("layer")).alias("layer"), "sensor_type", F.when(F.col("is_active"), F.col("depth")).alias("depth"))
    rules = filters.check_enums(d, {"layer": "layer_type", "sensor_type": "sensor_type"}, ["depth"])
    copies = filters.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"]).agg(F.lit("unique:order,line").alias("rule"), F.count(F.lit(1)).alias("violations"))
    return rules.unionByName(copies)


# --- sets and order ---------------------------------------------------------------------
@query("union_levels", sql("SELECT 'h' AS level, count(*) AS n FROM zh UNION ALL SELECT 'd', count(*) FROM zd", "zd"))
def _(t):
    levels = z(t)
    both = sets.stack(levels["hourly"].select(F.lit("h").alias("level"), "timestamp"), levels["daily"].select(F.lit("d").alias("level"), "date"))
    return both.groupBy("level").agg(F.count(F.lit(1)).alias("n"))


@query("concat_columns", sql("SELECT p_partkey, p_type || ': ' || p_brand AS label, p_type AS kind, p_brand AS detail FROM part"))
def _(t):
    df = t.part.select("p_partkey", F.concat_ws(": ", "p_type", "p_brand").alias("label"))
    kind, detail = text.material_parts(F.col("label"))
    return df.withColumns({"kind": kind, "detail": detail})


@query("union_dates", sql("SELECT CAST(ts AS DATE) AS day FROM events UNION SELECT CAST(o_orderdate AS DATE) FROM orders"))
def _(t):
    return sets.union_dates((t.events.select(F.col("ts").cast("date").alias("d")), "d"), (t.orders.select(F.col("o_orderdate").cast("date").alias("d")), "d"))


@query("order", sql(f"SELECT {columns('week_start', 'series_id', 'mean')} FROM zw ORDER BY week_start DESC, series_id", "zw"))
def _(t):
    return rnd(z(t)["weekly"].select("week_start", "series_id", "mean")).orderBy(F.desc("week_start"), "series_id")


@query("top_n", sql("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 25"))
def _(t):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return sets.top_n(li, [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey"], 25)


_TOP = "SELECT p_brand, sum(p_retailprice) AS s, row_number() OVER (ORDER BY sum(p_retailprice) DESC, p_brand) AS rk FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"


@query("pairs", sql("SELECT a.p_brand AS first, b.p_brand AS second FROM t a JOIN t b ON a.rk < b.rk", t=_TOP))
def _(t):
    score = t.part.groupBy("p_brand").agg(F.sum("p_retailprice").alias("s"))
    return sets.ranked_pairs(sets.top_n(score, [F.desc("s"), "p_brand"], 5), "p_brand", "s")


# --- scalar functions -------------------------------------------------------------------------
@query("time_functions", sql("""SELECT event_id, time_bucket(INTERVAL '15 minutes', ts) AS quarter, date_trunc('hour', ts) AS hour, CAST(ts AS DATE) AS day,
    CAST(date_trunc('week', ts) AS DATE) AS week, year(ts)::INT AS y, CAST(ts AS DATE) + 3 AS plus3, CAST(ts AS DATE) - 2 AS minus2,
    date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))::INT AS days, round(epoch_us(ts) / 1000000.0::DOUBLE, 3) AS unix,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM events"""))
def _(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id", times.bucket_start("ts", "15 minutes").alias("quarter"), times.hour_start("ts").alias("hour"), times.day_of("ts").alias("day"),
        times.week_of(times.day_of("ts")).alias("week"), times.year_of(F.date_format("ts", "yyyy-MM-dd")).alias("y"),
        F.date_add(times.day_of("ts"), 3).alias("plus3"), F.date_sub(times.day_of("ts"), 2).alias("minus2"),
        F.datediff(times.day_of("ts"), F.lit("2024-01-01").cast("date")).alias("days"), F.round(times.to_unix("ts"), 3).alias("unix"), times.iso(ts).alias("iso"),
    )


@query("text_functions", sql("""SELECT p_partkey, upper(substr(lower(p_name), 1, 1)) AS initial, replace(p_brand, 'Brand#', 'B') AS brand, trim('  ' || p_type || ' ') AS trimmed,
    lpad(p_size::VARCHAR, 4, '0') AS padded, starts_with(p_type, 'S') AS s_type, contains(p_name, 'ring') AS ring, p_brand || '_' || p_size AS key,
    regexp_extract(p_brand, '#([0-9]+)', 1) AS digits, CASE WHEN p_type IN ('SMALL', 'PROMO') THEN 2 ELSE 1 END AS code FROM part"""))
def _(t):
    p = F.col
    fine = F.when(p("p_type").isin("SMALL", "PROMO"), F.concat(F.lit("Fine-"), "p_type")).otherwise(p("p_type"))
    return t.part.select(
        "p_partkey", F.upper(F.substring(F.lower("p_name"), 1, 1)).alias("initial"), F.replace(p("p_brand"), F.lit("Brand#"), F.lit("B")).alias("brand"),
        F.trim(F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("trimmed"), F.lpad(p("p_size").cast("string"), 4, "0").alias("padded"),
        p("p_type").startswith("S").alias("s_type"), text.contains_any(p("p_name"), ["ring"]).alias("ring"), text.merge_key("p_brand", "p_size").alias("key"),
        F.regexp_extract("p_brand", "#([0-9]+)", 1).alias("digits"), text.material_code(fine).alias("code"),
    )


@query("unit_label", sql("""SELECT DISTINCT series_id AS metric_name, CASE series_id WHEN 'temperature' THEN 'Temperature (°C)' WHEN 'relative_humidity' THEN 'Humidity (%)'
    WHEN 'wind_speed' THEN 'Wind Speed (km/h)' WHEN 'dew_point' THEN 'Dew Point (°C)' ELSE series_id END AS label FROM weather""", "weather"))
def _(t):
    return t.weather().select(F.col("series_id").alias("metric_name"), text.unit_label(F.col("series_id")).alias("label")).distinct()


@query("numeric_functions", sql(f"""SELECT l_orderkey, l_linenumber, l_partkey, {r('sqrt(l_extendedprice)', 'root')}, {r('pow(l_quantity, 2)', 'square')}, {r('ln(1 + l_quantity)', 'log1p')},
    least(greatest(l_quantity, 10), 40) AS clipped, {r('l_extendedprice / (l_quantity + 1e-6)', 'ratio', 4)}, l_quantity * l_linenumber AS product, abs(l_quantity - 25) AS distance,
    coalesce(nullif(l_discount, 0.0), -1.0) AS discount FROM lineitem"""))
def _(t):
    q, price = F.col("l_quantity"), F.col("l_extendedprice")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(F.sqrt(price) + 1.7e-9, 6).alias("root"), F.round(F.pow(q, F.lit(2)) + 1.7e-9, 6).alias("square"),
        F.round(numeric.log1p(q) + 1.7e-9, 6).alias("log1p"), numeric.clip(q, F.lit(10.0), F.lit(40.0)).alias("clipped"),
        F.round(numeric.safe_ratio(price, q) + 1.7e-7, 4).alias("ratio"), (q * F.col("l_linenumber")).alias("product"), F.abs(q - 25).alias("distance"),
        F.coalesce(F.nullif("l_discount", F.lit(0.0)), F.lit(-1.0)).alias("discount"),
    )


@query("bin_midpoints", sql("SELECT l_returnflag, " + ", ".join(
    r(f"min(l_extendedprice) + (max(l_extendedprice) - min(l_extendedprice)) * {k + 0.5} / 4", f"m{k}") for k in range(4)) + " FROM lineitem GROUP BY 1"))
def _(t):
    lo, hi = F.min("l_extendedprice"), F.max("l_extendedprice")
    edges = t.lineitem.groupBy("l_returnflag").agg(F.array(*[lo + (hi - lo) * k / 4 for k in range(5)]).alias("e"))
    mids = edges.select("l_returnflag", numeric.midpoints(F.col("e")).alias("m"))
    return rnd(mids.select("l_returnflag", *[F.col("m")[i].alias(f"m{i}") for i in range(4)]))
