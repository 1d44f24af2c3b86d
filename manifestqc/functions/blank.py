"""Blank tests and whitespace handling as Column expressions.

Two strengths of "blank" exist in manifests: exact (null or the empty string)
and trimmed (nothing but whitespace).  Spark's ``trim`` only removes spaces, so
the trimmed form strips every white-space character (``WHITE``): ASCII ones, the
separators U+001C to U+001F and U+0085, and all Unicode spaces, such as the
no-break space of cells pasted from a spreadsheet.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from manifestqc.functions._col import as_col

# The NA tokens of the common CSV reader default, which turn a
# cell into null when a manifest is read with ``na_tokens="default"``.
DEFAULT_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


WHITE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"


def strip_ws(c) -> Column:
    """Remove leading and trailing whitespace of any kind (not only spaces).

    The expression tries every character of a value, so it only runs where the first or the last one is white."""
    c = as_col(c).cast("string")
    ends = F.concat(F.left(c, F.lit(1)), F.right(c, F.lit(1)))
    return F.when(ends.rlike(WHITE), F.regexp_replace(c, f"^{WHITE}+|{WHITE}+$", "")).otherwise(c)


def is_blank(c) -> Column:
    """Null or exactly the empty string."""
    c = as_col(c)
    return c.isNull() | (c == F.lit(""))


def is_blank_trimmed(c) -> Column:
    """Null or whitespace only."""
    c = as_col(c)
    return c.isNull() | (strip_ws(c) == F.lit(""))


def not_blank(c) -> Column:
    c = as_col(c)
    return c.isNotNull() & (c != F.lit(""))


def apply_na_tokens(c, tokens=DEFAULT_NA_TOKENS) -> Column:
    """Turn cells equal to one of ``tokens`` into null (exact, case-sensitive)."""
    c = as_col(c)
    tokens = list(tokens)
    if not tokens:
        return c
    return F.when(c.isin(tokens), F.lit(None).cast("string")).otherwise(c)
