"""Place names and coordinates as Column expressions.

Coordinates are rewritten from ``lat, lon`` decimal form to ``|lat| N|S |lon| E|W``.
Numbers are re-printed as text rather than through a double cast: a double
cast prints ``5.0E-4`` where the shortest decimal form is ``0.0005``.  The text
rewrite drops the sign, leading zeros and trailing zeros (keeping one digit
after the point), which equals the shortest round-trip form for inputs of up
to 15 significant digits and magnitudes in ``[1e-4, 1e16)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from manifestqc.functions._col import as_col
from manifestqc.functions.blank import strip_ws

RE_PLACE_COUNTRY_ONLY = r"^[A-Za-z\s]+$"
RE_LATLON_READY = r"^\d+\.\d+ [NS] \d+\.\d+ [EW]$"
RE_LATLON_DECIMAL = r"^(-?\d+\.\d+)[,\s]+(-?\d+\.\d+)$"


def normalize_geo(c, trimmed: Column | None = None) -> Column:
    """Blank -> ''; letters and spaces only -> append ``:``; else trimmed input."""
    c = as_col(c)
    t = strip_ws(c) if trimmed is None else trimmed
    return (
        F.when(c.isNull() | (t == ""), F.lit(""))
        .when(t.rlike(RE_PLACE_COUNTRY_ONLY), F.concat(t, F.lit(":")))
        .otherwise(t)
    )


def decimal_text(num: Column) -> Column:
    """Absolute value of a ``-?\\d+\\.\\d+`` text in shortest decimal form."""
    unsigned = F.regexp_replace(num, r"^-", "")
    no_lead = F.regexp_replace(unsigned, r"^0+(\d)", "$1")
    return F.regexp_replace(no_lead, r"(\.\d+?)0+$", "$1")


def is_negative_text(num: Column) -> Column:
    """True when a signed decimal text is below zero (``-0.0`` is not)."""
    return num.rlike(r"^-.*[1-9]")


def normalize_latlon(c, trimmed: Column | None = None) -> Column:
    """Blank -> ''; ready form kept; ``lat[, ]lon`` decimals rewritten; else trimmed input."""
    c = as_col(c)
    t = strip_ws(c) if trimmed is None else trimmed
    lat = F.regexp_extract(t, RE_LATLON_DECIMAL, 1)
    lon = F.regexp_extract(t, RE_LATLON_DECIMAL, 2)
    rewritten = F.concat_ws(
        " ",
        decimal_text(lat),
        F.when(is_negative_text(lat), F.lit("S")).otherwise(F.lit("N")),
        decimal_text(lon),
        F.when(is_negative_text(lon), F.lit("W")).otherwise(F.lit("E")),
    )
    return (
        F.when(c.isNull() | (t == ""), F.lit(""))
        .when(t.rlike(RE_LATLON_READY), t)
        .when(t.rlike(RE_LATLON_DECIMAL), rewritten)
        .otherwise(t)
    )
