"""Synonym canonicalisation, keyword inference and transfer-log outcome."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from manifestqc.functions._col import as_col
from manifestqc.functions.blank import strip_ws

# Synonym tables (canonical value -> accepted spellings, compared
# lower-cased and trimmed).
LAYOUT_SYNONYMS = {"paired": ("paired", "pair", "pe"), "single": ("single", "se")}
SOURCE_SYNONYMS = {
    "environmental": ("environmental", "environment"),
    "host-associated": ("host-associated", "host", "host associated"),
}

# Title keywords (case-sensitive substrings) and what they imply.
HOST_KEYWORDS = (("Human", "Homo sapiens"), ("Mouse", "Mus musculus"))
STOOL_KEYWORD = "Stool"

RE_FAILED_COUNT = r"(?i)(\d+)\s+files?\s+failed"
SESSION_STOP = "Session Stop"


def canonicalize(c, synonyms: Mapping[str, Sequence[str]]) -> Column:
    """Map a value to its canonical spelling when ``lower(trim(value))`` is a
    listed synonym; other values (null included) pass through unchanged.  One
    lookup in a literal map, so the value is trimmed once."""
    c = as_col(c)
    spelling: dict[str, str] = {}
    for canon, words in synonyms.items():
        for word in words:
            spelling.setdefault(word, canon)
    if not spelling:
        return c
    known = F.create_map(*[F.lit(x) for kv in spelling.items() for x in kv])
    return F.coalesce(F.try_element_at(known, F.lower(strip_ws(c))), c)


def infer_sample_source(title) -> Column:
    t = as_col(title)
    host = None
    for word, _ in HOST_KEYWORDS:
        cond = t.contains(word)
        host = cond if host is None else (host | cond)
    return F.when(host, F.lit("host-associated")).otherwise(F.lit("environmental"))


def infer_host(title) -> Column:
    t = as_col(title)
    out = None
    for word, organism in HOST_KEYWORDS:
        cond = t.contains(word)
        out = F.when(cond, F.lit(organism)) if out is None else out.when(cond, F.lit(organism))
    return out.otherwise(F.lit(""))


def infer_isolation_source(title) -> Column:
    t = as_col(title)
    return F.when(t.contains(STOOL_KEYWORD), F.lit(STOOL_KEYWORD)).otherwise(F.lit(""))


def transfer_failed(exit_code, output) -> Column:
    """A transfer attempt failed when it exited non-zero, when its log holds
    ``Session Stop``, or when the first ``<N> file(s) failed`` (any case) has N > 0."""
    code = as_col(exit_code)
    out = F.coalesce(as_col(output), F.lit(""))
    first_count = F.regexp_extract(out, RE_FAILED_COUNT, 1)
    return (
        code.isNull()
        | (code != 0)
        | out.contains(SESSION_STOP)
        | first_count.rlike("[1-9]")
    )


def transfer_ok(exit_code, output) -> Column:
    return ~transfer_failed(exit_code, output)
