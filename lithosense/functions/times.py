"""Time expressions.  Instants are TIMESTAMP_NTZ, days are DATE."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lithosense.constants import FILE_DATE_PATTERNS, STATION_TIME_PATTERN

WIDTH = {"15min": "15 minutes", "hourly": "1 hour", "daily": "1 day"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(c: Column | str) -> Column:
    """As TIMESTAMP_NTZ (wall clock of the session zone, which is UTC)."""
    return _col(c).cast("timestamp_ntz")


def bucket_start(ts: Column | str, width: str) -> Column:
    """Start of the tumbling bucket.  Stays NTZ and compiles to long arithmetic,
    so it is a cheap primitive grouping key.  One such call per select."""
    return F.window(_col(ts), width)["start"]


def day_of(ts: Column | str) -> Column:
    return _col(ts).cast("date")


def week_of(day: Column | str) -> Column:
    """Monday on or before ``day``, as DATE."""
    day = _col(day)
    return F.date_sub(day, F.weekday(day))


def hour_start(ts: Column | str) -> Column:
    return F.date_trunc("hour", _col(ts)).cast("timestamp_ntz")


def year_of(text: Column | str) -> Column:
    """Year of a date string; NULL where it does not parse."""
    return F.year(F.to_date(F.try_to_timestamp(_col(text))))


def plus_seconds(start: Column, seconds: Column | str) -> Column:
    """``start`` + fractional seconds, to the microsecond."""
    micros = F.round(_col(seconds).cast("double") * F.lit(1e6)).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, start)


def seconds_between(earlier: Column, later: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(1e6)


def from_unix(seconds: Column | str) -> Column:
    """Unix seconds (text or number) to NTZ; NULL where not numeric."""
    return F.timestamp_micros(
        F.round(_col(seconds).try_cast("double") * F.lit(1e6)).cast("bigint")
    ).cast("timestamp_ntz")


def to_unix(ts: Column | str) -> Column:
    """NTZ to (fractional) Unix seconds."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _col(ts)) / F.lit(1e6)


def iso(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss")


def station_timestamp(text: Column | str) -> Column:
    """Station clock text to NTZ: optional quote, date and time kept, any zone
    suffix ignored; NULL where the text does not start that way."""
    lead = F.regexp_extract(_col(text), STATION_TIME_PATTERN, 1)
    return F.try_to_timestamp(F.nullif(lead, F.lit("")), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def any_timestamp(text: Column | str) -> Column:
    """Any timestamp or date text Spark can read; NULL otherwise."""
    return F.try_to_timestamp(_col(text).cast("string")).cast("timestamp_ntz")


def file_date(name: Column | str) -> Column:
    """Calendar date in a file name by the first matching pattern, else NULL."""
    name = _col(name)

    def parsed(pattern: str, year: int, month: int, day: int) -> Column:
        parts = [F.regexp_extract(name, pattern, year)] + [
            F.lpad(F.regexp_extract(name, pattern, g), 2, "0") for g in (month, day)
        ]
        return F.to_date(F.try_to_timestamp(F.concat_ws("-", *parts), F.lit("yyyy-MM-dd")))

    # A name that matches an earlier pattern never falls through to a later one.
    out = F.lit(None).cast("date")
    for pattern, y, m, d in reversed(FILE_DATE_PATTERNS):
        out = F.when(name.rlike(pattern), parsed(pattern, y, m, d)).otherwise(out)
    return out


def resolve_start(prop: Column, name: Column, modified: Column) -> Column:
    """Start instant: file property, else date in the name, else modification day."""
    return F.coalesce(
        any_timestamp(prop),
        file_date(name).cast("timestamp_ntz"),
        modified.cast("date").cast("timestamp_ntz"),
    )
