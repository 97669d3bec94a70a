"""Text expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def contains_any(c: Column, words) -> Column:
    """True where any of ``words`` occurs in ``c``."""
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words], F.lit(False))


def material_parts(text: Column) -> list[Column]:
    """``Kind: detail`` to its two parts (second NULL when there is no detail)."""
    parts = F.split(text, ": ", 2)
    return [F.get(parts, F.lit(0)), F.get(parts, F.lit(1))]


def material_code(text: Column, null_code: int = 2) -> Column:
    """2 for fine-grained material, otherwise 1.  A missing text counts as
    ``null_code``: 2 is what spreadsheet input gives in the source analysis."""
    return (
        F.when(text.isNull(), F.lit(null_code))
        .when(text.startswith("Fine-"), F.lit(2))
        .otherwise(F.lit(1))
        .cast("int")
    )


# fixed values: words that must all occur in the metric name -> axis label, by priority
_LABELS = (
    (("temperature",), "Temperature (°C)"),
    (("humidity",), "Humidity (%)"),
    (("pressure",), "Pressure (kPa)"),
    (("wind", "speed"), "Wind Speed (km/h)"),
    (("wind", "gust"), "Wind Gust (km/h)"),
    (("precipitation",), "Precipitation (mm)"),
    (("dew",), "Dew Point (°C)"),
)


def unit_label(metric: Column) -> Column:
    """Axis label with unit by words in the metric name; the name itself otherwise."""
    name = F.lower(metric)
    known = [
        F.when(reduce(lambda a, b: a & b, [name.contains(w) for w in words]), F.lit(label))
        for words, label in _LABELS
    ]
    return F.coalesce(*known, metric)


def merge_key(*cols: Column | str) -> Column:
    """Composite text key, parts joined by an underscore."""
    return F.concat_ws("_", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])
