"""Collection-date normalisation to ISO-8601 text, as one Column expression.

Dates stay text on purpose: partial dates (``2017``, ``2017-07``), ranges
(``a/b``) and words such as ``not collected`` are valid values that a
``DateType`` would lose.  Rules, first that fires wins:

1. null or whitespace only -> ``''`` (strict: ``not collected``)
2. ``not collected`` / ``not provided`` / ``unknown`` in any case -> trimmed input
3. already ISO (``YYYY``, ``YYYY-MM``, ``YYYY-MM-DD``, ``YYYY-MM-DDThh:mm:ssZ``) -> trimmed input,
   no calendar check
4. contains ``/`` but is not ``d/d/YYYY`` and splits into exactly two parts ->
   both parts normalised by rules 1-3 and 6-9; joined with ``/`` when both are non-empty
5. ``d1/d2/YYYY`` -> day first when ``d1 > 12``, else month first; a month outside
   1..12 or a day outside 1..31 becomes ``01``; zero padded
6. ``D[D]<sep>Mon<sep>YYYY`` (sep is ``-``, ``/`` or whitespace, month in any case) -> ``YYYY-MM-DD``
7. ``Mon<sep>YYYY`` -> ``YYYY-MM``
8. ``YYYY[-/]M[M][-/]D[D]`` -> zero padded ``YYYY-MM-DD``
9. anything else -> trimmed input (strict: ``not collected``)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from manifestqc.functions._col import as_col
from manifestqc.functions.blank import strip_ws

# English month abbreviations and their numbers.
MONTHS = {
    "jan": "01", "feb": "02", "mar": "03", "apr": "04", "may": "05", "jun": "06",
    "jul": "07", "aug": "08", "sep": "09", "oct": "10", "nov": "11", "dec": "12",
}
# Words that are kept as they are (compared lower-cased).
KEEP_WORDS = ("not collected", "not provided", "unknown")
NOT_COLLECTED = "not collected"

RE_ISO = r"^\d{4}(-\d{2}(-\d{2}(T\d{2}:\d{2}:\d{2}Z)?)?)?$"
RE_NUMERIC = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
RE_DAY_MON_YEAR = r"^(\d{1,2})[-/\s]([A-Za-z]{3})[-/\s](\d{4})$"
RE_MON_YEAR = r"^([A-Za-z]{3})[-/\s](\d{4})$"
RE_YEAR_MON_DAY = r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})$"


def _month_number(abbr: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    return F.try_element_at(m, F.lower(abbr))


def _pad2(c: Column) -> Column:
    return F.lpad(c, 2, "0")


def _textual_rules(t: Column, chain):
    """Rules 6-8 on a trimmed value, appended to an open ``when`` chain."""
    dmy_mon = _month_number(F.regexp_extract(t, RE_DAY_MON_YEAR, 2))
    my_mon = _month_number(F.regexp_extract(t, RE_MON_YEAR, 1))
    return (
        chain.when(
            t.rlike(RE_DAY_MON_YEAR) & dmy_mon.isNotNull(),
            F.concat_ws("-", F.regexp_extract(t, RE_DAY_MON_YEAR, 3), dmy_mon,
                        _pad2(F.regexp_extract(t, RE_DAY_MON_YEAR, 1))),
        )
        .when(
            t.rlike(RE_MON_YEAR) & my_mon.isNotNull(),
            F.concat_ws("-", F.regexp_extract(t, RE_MON_YEAR, 2), my_mon),
        )
        .when(
            t.rlike(RE_YEAR_MON_DAY),
            F.concat_ws("-", F.regexp_extract(t, RE_YEAR_MON_DAY, 1),
                        _pad2(F.regexp_extract(t, RE_YEAR_MON_DAY, 2)),
                        _pad2(F.regexp_extract(t, RE_YEAR_MON_DAY, 3))),
        )
    )


def _head(c: Column, strict: bool, trimmed: Column | None = None):
    """Rules 1-3, returning (trimmed value, open when-chain)."""
    t = strip_ws(c) if trimmed is None else trimmed
    blank_out = F.lit(NOT_COLLECTED if strict else "")
    chain = (
        F.when(c.isNull() | (t == ""), blank_out)
        .when(F.lower(t).isin(*KEEP_WORDS), t)
        .when(t.rlike(RE_ISO), t)
    )
    return t, chain


def _atom(t: Column, strict: bool) -> Column:
    """One trimmed side of a range: every rule except the two that need a slash."""
    t, chain = _head(t, strict, t)
    fallback = F.lit(NOT_COLLECTED) if strict else t
    return _textual_rules(t, chain).otherwise(fallback)


def _numeric_date(t: Column) -> Column:
    d1s = F.regexp_extract(t, RE_NUMERIC, 1)
    d2s = F.regexp_extract(t, RE_NUMERIC, 2)
    year = F.regexp_extract(t, RE_NUMERIC, 3)
    day_first = d1s.try_cast("int") > 12
    month_s = F.when(day_first, d2s).otherwise(d1s)
    day_s = F.when(day_first, d1s).otherwise(d2s)
    month_i = month_s.try_cast("int")
    day_i = day_s.try_cast("int")
    month = F.when((month_i < 1) | (month_i > 12), F.lit("01")).otherwise(_pad2(month_s))
    day = F.when((day_i < 1) | (day_i > 31), F.lit("01")).otherwise(_pad2(day_s))
    return F.concat_ws("-", year, month, day)


def normalize_date(c, strict: bool = False, trimmed: Column | None = None) -> Column:
    """Normalise a date cell (see module doc).  ``strict`` maps blanks and
    unrecognised values to ``not collected``.  ``trimmed``: a column that holds ``strip_ws(c)``, which
    the rules name many times over."""
    c = as_col(c)
    t, chain = _head(c, strict, trimmed)
    parts = F.split(t, "/")
    # Both halves go through one lambda so the atom rules are generated once; they are trimmed before.
    halves = F.transform(F.transform(parts, strip_ws), lambda p: _atom(p, strict))
    is_range = (
        t.contains("/")
        & ~t.rlike(RE_NUMERIC)
        & (F.size(parts) == 2)
        & ~F.array_contains(halves, "")
    )
    chain = chain.when(is_range, F.array_join(halves, "/"))
    chain = chain.when(t.rlike(RE_NUMERIC), _numeric_date(t))
    fallback = F.lit(NOT_COLLECTED) if strict else t
    return _textual_rules(t, chain).otherwise(fallback)


def normalize_date_strict(c) -> Column:
    return normalize_date(c, strict=True)
