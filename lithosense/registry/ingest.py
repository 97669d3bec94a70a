"""Channels, timestamps, coercion, series selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithosense.functions import times
from lithosense.functions.numeric import to_double
from lithosense.operators import ingest as I
from lithosense.operators.filters import quarantine
from lithosense.operators.windows import dense_index
from lithosense.registry.base import METRIC_OF, query, r, rnd, sql


def channel_samples(t):
    """Decoded channels of two files: one value channel per event type, indexed in time
    order, a clock, a shorter clock, and a channel of words."""
    src = t.events.withColumn("file", F.concat(F.lit("run_2024-01-0"), F.col("user_id") % 2 + 1, F.lit(".bin")))
    ev = dense_index(src, ["file", "event_type"], "ts", ("event_id",))
    kind, idx, lit = F.col("event_type"), F.col("idx"), F.lit
    tick = (idx * 10 + idx % 3).cast("double").cast("string")

    def row(grp, channel, at, value):
        return F.struct(lit(grp).alias("grp"), channel.alias("channel"), at.cast("bigint").alias("idx"), value.alias("value"))

    rows = F.array(
        row("G1", kind, idx, F.col("value").cast("string")),
        F.when(kind == "signup", row("G1", lit("Time"), idx, tick)),
        F.when((kind == "signup") & (idx % 2 == 0), row("G2", lit("Time"), idx / 2, tick)),
        F.when(kind == "view", row("G2", lit("note"), idx, F.col("props"))),
    )
    return ev.select("file", F.inline(F.filter(rows, lambda r: r.isNotNull())))


_SAMPLES = {
    "ev": """SELECT *, row_number() OVER (PARTITION BY file, event_type ORDER BY ts, event_id) - 1 AS idx
        FROM (SELECT *, 'run_2024-01-0' || (user_id % 2 + 1) || '.bin' AS file FROM events)""",
    "vals": "SELECT file, 'G1' AS grp, event_type AS channel, idx, value FROM ev",
    "clk": "SELECT file, idx, (idx * 10 + idx % 3)::DOUBLE AS t FROM ev WHERE event_type = 'signup'",
}


@query("pick_time_channel", sql(
    "SELECT file, 'G1' AS grp, 'Time' AS channel, count(*) AS n, min(t) AS low, max(t) AS high FROM clk GROUP BY file", **_SAMPLES))
def _(t):
    return I.pick_time_channel(I.channel_lengths(channel_samples(t)))


@query("pick_time_channel_tie", sql("SELECT file, 'A9' AS grp, 'Time' AS channel, count(*) AS n, min(t) AS low, max(t) AS high FROM clk GROUP BY file", **_SAMPLES))
def _(t):
    """Two clocks of one length: the first in file order counts, whatever its group is called."""
    s = channel_samples(t).where(F.col("grp") == "G1")
    clocks = s.where(F.col("channel") == "Time")
    s = s.where(F.col("channel") != "Time").unionByName(clocks.withColumn("grp", F.lit("A9"))).unionByName(clocks.withColumn("grp", F.lit("A1")))
    order = s.select("file", "grp", "channel").distinct().withColumn("ordinal", F.when(F.col("grp") == "A9", 1).otherwise(2))
    return I.pick_time_channel(I.with_ordinals(I.channel_lengths(s), order)).drop("ordinal")


@query("last_of_name", sql("SELECT file, 'A0' AS grp, channel, count(*) AS n FROM vals GROUP BY 1, 3", **_SAMPLES))
def _(t):
    """Every value channel twice under one name: the last in file order counts."""
    s = channel_samples(t).where((F.col("grp") == "G1") & (F.col("channel") != "note"))
    s = s.unionByName(s.withColumn("grp", F.lit("A0")))
    order = s.select("file", "grp", "channel").distinct().withColumn("ordinal", F.when(F.col("grp") == "A0", 7).otherwise(3))
    return I.last_of_name(I.drop_bad_channels(I.with_ordinals(I.channel_lengths(s), order))).select("file", "grp", "channel", "n")


@query("drop_bad_channels", sql("SELECT file, grp, channel, count(*) AS n FROM vals GROUP BY 1, 2, 3", **_SAMPLES))
def _(t):
    return I.drop_bad_channels(I.channel_lengths(channel_samples(t))).select("file", "grp", "channel", "n")


_REGRID = {
    **_SAMPLES,
    "len": "SELECT file, channel, count(*) AS n FROM vals GROUP BY 1, 2",
    "span": "SELECT file, min(t) AS t0, max(t) AS t1, count(*) AS points FROM clk GROUP BY 1",
    "pos": "SELECT file, channel, idx, t, n, CASE WHEN n = points THEN idx::DOUBLE ELSE (t - t0) / (t1 - t0) * (n - 1) END AS p FROM clk JOIN span USING (file) JOIN len USING (file)",
    "seg": "SELECT *, least(greatest(floor(p)::BIGINT, 0), n - 2) AS i FROM pos",
    "grid": """SELECT s.file, s.channel, s.idx, s.t, CASE WHEN p = i THEN a.value ELSE a.value + (p - i) * (b.value - a.value) END AS y FROM seg s
        JOIN vals a ON a.file = s.file AND a.channel = s.channel AND a.idx = s.i JOIN vals b ON b.file = s.file AND b.channel = s.channel AND b.idx = s.i + 1""",
}


@query("regrid_linear", sql(f"SELECT file, channel, idx, t AS time, {r('y', 'value')} FROM grid", **_REGRID))
def _(t):
    s = channel_samples(t)
    lengths = I.channel_lengths(s)
    return rnd(I.regrid_linear(s, lengths, I.pick_time_channel(lengths), slice_rows=256).select("file", "channel", "idx", "time", "value"))


@query("readings_from_channels", sql(
    f"SELECT CAST(substr(file, 5, 10) AS TIMESTAMP) + to_microseconds((t * 1000000)::BIGINT) AS \"timestamp\", channel AS series_id, {r('y', 'value')} FROM grid", **_REGRID))
def _(t):
    s = channel_samples(t)
    meta = s.groupBy("file", "grp", "channel").agg(F.count(F.lit(1)).alias("n")).select(
        "*", F.lit(0).alias("ordinal"), F.create_map().cast("map<string,string>").alias("props"), F.lit("2020-05-05 10:00:00").cast("timestamp").alias("modified"))
    return rnd(I.readings_from_channels(s, meta).drop("file"))


@query("dense_index", sql("SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS idx FROM events"))
def _(t):
    return dense_index(t.events, ["event_type"], "ts", ("event_id",)).select("event_id", "idx")


@query("ts_from_offset", sql("SELECT event_id, TIMESTAMP '2024-01-01' + to_microseconds(round(value * 1000000)::BIGINT) AS \"timestamp\" FROM events"))
def _(t):
    return I.ts_from_offset(t.events.select("event_id", F.col("value").alias("Time")), "2024-01-01 00:00:00").select("event_id", "timestamp")


@query("synth_ts", sql("SELECT event_id, TIMESTAMP '2024-03-01 06:00:00' + to_seconds(event_id * 10) AS \"timestamp\" FROM events"))
def _(t):
    src = t.events.select("event_id", F.col("event_id").alias("idx"), F.lit("2024-03-01 06:00:00").cast("timestamp_ntz").alias("modified"))
    return I.synth_ts(src).select("event_id", "timestamp")


def _file_names(t):
    ymd = F.date_format("ts", "yyyy_M_d")
    return t.events.select(
        "event_id",
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("Waterloo_R1_"), F.date_format("ts", "MM_dd_yyyy"), F.lit("_00_11.bin")))
        .when(F.col("event_id") % 5 == 1, F.concat(F.lit("x_"), ymd, F.lit(".bin")))
        .when(F.col("event_id") % 5 == 2, F.concat(F.lit("x_"), F.date_format("ts", "M-d-yyyy"), F.lit(".bin")))
        .otherwise("plain.bin").alias("name"),
        F.when(F.col("event_id") % 5 == 3, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("prop"),
        F.lit("2020-05-05 10:00:00").cast("timestamp_ntz").alias("modified"),
    )


@query("resolve_start", sql("""SELECT event_id, CASE event_id % 5 WHEN 3 THEN date_trunc('second', ts) WHEN 4 THEN TIMESTAMP '2020-05-05'
    ELSE CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS start FROM events"""))
def _(t):
    return _file_names(t).select("event_id", times.resolve_start(F.col("prop"), F.col("name"), F.col("modified")).alias("start"))


@query("resolve_ts_columns", sql("SELECT event_id, date_trunc('second', ts) AS \"timestamp\" FROM events"))
def _(t):
    src = t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("Date"), F.date_format("ts", "HH:mm:ss").alias("Time"))
    return I.resolve_ts_columns(src).select("event_id", "timestamp")


def _station_text(t):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return t.events.select(
        "event_id",
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('"'), text, F.lit(' EDT"')))
        .when(F.col("event_id") % 4 == 1, F.concat(text, F.lit(" EST")))
        .when(F.col("event_id") % 4 == 2, text)
        .otherwise(F.concat(F.lit("at "), text)).alias("date_time_local"),
        F.when(F.col("event_id") % 6 == 0, F.lit("n/a")).when(F.col("event_id") % 6 == 1, F.lit("NaN")).otherwise(F.col("value").cast("string")).alias("temperature"),
    )


@query("clean_weather_ts", sql("SELECT event_id, CASE WHEN event_id % 4 < 3 THEN date_trunc('second', ts) END AS \"timestamp\" FROM events"))
def _(t):
    return _station_text(t).select("event_id", times.station_timestamp("date_time_local").alias("timestamp"))


@query("resolve_weather_ts", sql("SELECT event_id, TIMESTAMP '1970-01-01' + to_seconds((epoch_us(ts) // 1000000)::BIGINT) AS \"timestamp\" FROM events"))
def _(t):
    src = t.events.select("event_id", F.floor(times.to_unix("ts")).cast("string").alias("unixtime"))
    return I.resolve_weather_ts(src).select("event_id", "timestamp")


@query("coerce_numeric", sql("SELECT event_id::DOUBLE AS event_id, CASE WHEN event_id % 6 > 1 THEN value END AS temperature FROM events"))
def _(t):
    return I.coerce_numeric(_station_text(t)).select("event_id", "temperature")


@query("drop_null_ts", sql("SELECT event_id, date_trunc('second', ts) AS \"timestamp\" FROM events WHERE event_id % 4 < 3"))
def _(t):
    return I.drop_null_ts(I.resolve_weather_ts(_station_text(t))).select("event_id", "timestamp")


@query("quarantine", sql("""SELECT coalesce(reason, 'ok') AS reason, count(*) AS n FROM (SELECT CASE WHEN event_id % 4 = 3 THEN 'bad timestamp'
    WHEN event_id % 6 <= 1 THEN 'bad temperature' END AS reason FROM events) GROUP BY 1"""))
def _(t):
    src = I.resolve_weather_ts(_station_text(t))
    good, bad = quarantine(src, {"bad timestamp": F.col("timestamp").isNull(), "bad temperature": to_double("temperature").isNull()})
    return good.withColumn("reason", F.lit("ok")).unionByName(bad).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _wide(t):
    """One column per metric on hourly means."""
    return t.weather().groupBy(F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("timestamp")).agg(
        *[F.max(F.when(F.col("series_id") == m, F.col("value"))).alias(m) for m in METRIC_OF.values()]
    )


@query("to_long", sql("SELECT date_trunc('hour', \"timestamp\") AS \"timestamp\", series_id, max(value) AS value FROM weather GROUP BY 1, 2", "weather"))
def _(t):
    return I.to_long(_wide(t))


@query("metric_select", sql(
    "SELECT date_trunc('hour', \"timestamp\") AS \"timestamp\", " + ", ".join(f"max(CASE WHEN series_id = '{m}' THEN value END) AS {m}" for m in METRIC_OF.values()) + " FROM weather GROUP BY 1", "weather"))
def _(t):
    return I.metric_select(_wide(t).withColumn("battery", F.lit(1.0)))


@query("identify_series", sql("SELECT DISTINCT 'TM-' || p_brand AS series_id FROM part WHERE p_brand LIKE 'Brand#1%'"))
def _(t):
    """No exact id occurs among the names, so the keyword rule decides."""
    hot = F.col("p_brand").startswith("Brand#1")
    names = t.part.select(F.when(hot, F.concat(F.lit("TM-"), "p_brand")).otherwise(F.col("p_brand")).alias("series_id"))
    return I.identify_series_long(names)


@query("identify_series_known", sql("SELECT DISTINCT p_brand AS series_id FROM part WHERE contains(p_brand, 'Brand#2')"))
def _(t):
    names = t.part.select(F.col("p_brand").alias("series_id")).union(t.part.select(F.concat(F.lit("temp_"), "p_type")))
    return I.identify_series_long(names, known=("Brand#2",))


@query("enrich_sensor", sql("SELECT event_id, \"timestamp\", series_id, round(value, 2) AS value, depth, layer FROM readings JOIN dim ON series_id = sensor_id", "readings", "dim"))
def _(t):
    return I.enrich_sensor(t.readings(), t.dim())


@query("profile", sql("SELECT min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT ts) AS distinct_ts, count(value) AS n_value, count(CASE WHEN event_id % 3 = 0 THEN value END) AS n_third FROM events"))
def _(t):
    return I.profile(t.events.select("ts", "value", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("third")), "ts")
