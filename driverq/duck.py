"""The manifest rules re-stated as DuckDB SQL text, for the oracle queries.

Written from the rule statements (RE2 regexes, 1-based lists,
``regexp_replace`` with the ``g`` flag); month names, keep-words and synonyms
are the library's fixed values."""

from __future__ import annotations

from manifestqc.functions.dates import KEEP_WORDS, MONTHS
from manifestqc.functions.text import LAYOUT_SYNONYMS, SOURCE_SYNONYMS


def q(v: str | None) -> str:
    if v is None:
        return "NULL"
    return "'" + v.replace("'", "''") + "'"


def strip(x: str) -> str:
    white = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
    return f"regexp_replace({x}, '^{white}+|{white}+$', '', 'g')"


def blank(x: str) -> str:
    return f"({x} IS NULL OR {x} = '')"


def not_blank(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> '')"


def blank_t(x: str) -> str:
    return f"({x} IS NULL OR {strip(x)} = '')"


def in_list(x: str, vals) -> str:
    return f"{x} IN ({', '.join(q(v) for v in vals)})"


def month(m: str) -> str:
    return "CASE lower(" + m + ") " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MONTHS.items()) + " END"


ISO = r"^\d{4}(-\d{2}(-\d{2}(T\d{2}:\d{2}:\d{2}Z)?)?)?$"
NUM = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
DMY = r"^(\d{1,2})[-/\s]([A-Za-z]{3})[-/\s](\d{4})$"
MY = r"^([A-Za-z]{3})[-/\s](\d{4})$"
YMD = r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})$"


def _rx(t: str, p: str, g: int) -> str:
    return f"regexp_extract({t}, '{p}', {g})"


def _tail_rules(t: str, fallback: str) -> str:
    m1 = month(_rx(t, DMY, 2))
    m2 = month(_rx(t, MY, 1))
    return f"""WHEN regexp_matches({t}, '{DMY}') AND {m1} IS NOT NULL
        THEN {_rx(t, DMY, 3)} || '-' || {m1} || '-' || lpad({_rx(t, DMY, 1)}, 2, '0')
      WHEN regexp_matches({t}, '{MY}') AND {m2} IS NOT NULL THEN {_rx(t, MY, 2)} || '-' || {m2}
      WHEN regexp_matches({t}, '{YMD}')
        THEN {_rx(t, YMD, 1)} || '-' || lpad({_rx(t, YMD, 2)}, 2, '0') || '-' || lpad({_rx(t, YMD, 3)}, 2, '0')
      ELSE {fallback} END"""


def _head(x: str, t: str, strict: bool) -> str:
    b = "'not collected'" if strict else "''"
    return f"""CASE WHEN {x} IS NULL OR {t} = '' THEN {b}
      WHEN {in_list(f'lower({t})', KEEP_WORDS)} THEN {t}
      WHEN regexp_matches({t}, '{ISO}') THEN {t}"""


def atom(x: str, strict: bool) -> str:
    t = strip(x)
    fb = "'not collected'" if strict else t
    return _head(x, t, strict) + "\n      " + _tail_rules(t, fb)


def date(x: str, strict: bool = False) -> str:
    t = strip(x)
    parts = f"string_split({t}, '/')"
    a = atom(f"{parts}[1]", strict)
    b = atom(f"{parts}[2]", strict)
    d1 = _rx(t, NUM, 1)
    d2 = _rx(t, NUM, 2)
    yr = _rx(t, NUM, 3)
    day_first = f"TRY_CAST({d1} AS INTEGER) > 12"
    mon_s = f"(CASE WHEN {day_first} THEN {d2} ELSE {d1} END)"
    day_s = f"(CASE WHEN {day_first} THEN {d1} ELSE {d2} END)"
    mon = f"(CASE WHEN TRY_CAST({mon_s} AS INTEGER) NOT BETWEEN 1 AND 12 THEN '01' ELSE lpad({mon_s}, 2, '0') END)"
    day = f"(CASE WHEN TRY_CAST({day_s} AS INTEGER) NOT BETWEEN 1 AND 31 THEN '01' ELSE lpad({day_s}, 2, '0') END)"
    fb = "'not collected'" if strict else t
    return (_head(x, t, strict) + f"""
      WHEN contains({t}, '/') AND NOT regexp_matches({t}, '{NUM}') AND len({parts}) = 2
           AND ({a}) <> '' AND ({b}) <> '' THEN ({a}) || '/' || ({b})
      WHEN regexp_matches({t}, '{NUM}') THEN {yr} || '-' || {mon} || '-' || {day}
      """ + _tail_rules(t, fb))


def geo(x: str) -> str:
    t = strip(x)
    return rf"""CASE WHEN {x} IS NULL OR {t} = '' THEN ''
      WHEN regexp_matches({t}, '^[A-Za-z\s]+$') THEN {t} || ':'
      ELSE {t} END"""


def _dec(num: str) -> str:
    u = f"regexp_replace({num}, '^-', '')"
    u = rf"regexp_replace({u}, '^0+(\d)', '\1')"
    return rf"regexp_replace({u}, '(\.\d+?)0+$', '\1')"


def latlon(x: str) -> str:
    t = strip(x)
    pat = r"^(-?\d+\.\d+)[,\s]+(-?\d+\.\d+)$"
    lat = f"regexp_extract({t}, '{pat}', 1)"
    lon = f"regexp_extract({t}, '{pat}', 2)"
    ns = f"CASE WHEN regexp_matches({lat}, '^-.*[1-9]') THEN 'S' ELSE 'N' END"
    ew = f"CASE WHEN regexp_matches({lon}, '^-.*[1-9]') THEN 'W' ELSE 'E' END"
    return rf"""CASE WHEN {x} IS NULL OR {t} = '' THEN ''
      WHEN regexp_matches({t}, '^\d+\.\d+ [NS] \d+\.\d+ [EW]$') THEN {t}
      WHEN regexp_matches({t}, '{pat}') THEN {_dec(lat)} || ' ' || {ns} || ' ' || {_dec(lon)} || ' ' || {ew}
      ELSE {t} END"""


def canon(x: str, synonyms) -> str:
    key = f"lower({strip(x)})"
    whens = " ".join(f"WHEN {in_list(key, words)} THEN {q(c)}" for c, words in synonyms.items())
    return f"CASE {whens} ELSE {x} END"


def layout(x: str) -> str:
    return canon(x, LAYOUT_SYNONYMS)


def source(x: str) -> str:
    return canon(x, SOURCE_SYNONYMS)


def basename(x: str) -> str:
    return f"regexp_extract({x}, '([^/]*)$', 1)"


def resolve(p: str, base: str | None) -> str:
    if not base:
        return p
    joined = f"{q(base)} || {p}" if base.endswith("/") else f"{q(base + '/')} || {p}"
    return f"CASE WHEN starts_with({p}, '/') OR regexp_matches({p}, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN {p} ELSE {joined} END"


def expected_mate(n: str) -> str:
    return rf"""CASE WHEN regexp_matches({n}, '_R1[._]') THEN regexp_replace({n}, '_R1([._])', '_R2\1', 'g')
      WHEN regexp_matches({n}, '_1\.') THEN regexp_replace({n}, '_1\.', '_2.', 'g')
      WHEN contains({n}, '_forward') THEN replace({n}, '_forward', '_reverse')
      WHEN regexp_matches({n}, '_f\.') THEN regexp_replace({n}, '_f\.', '_r.', 'g')
      ELSE NULL END"""


def sample_from_file(p: str) -> str:
    return rf"regexp_replace({basename(p)}, '_R?[12]\..*$', '')"


def mate_name(f: str) -> str:
    return f"CASE WHEN contains({f}, '_R1') OR contains({f}, '_1.') THEN replace(replace({f}, '_R1', '_R2'), '_1.', '_2.') ELSE '' END"


def vocab_bad(x: str, vals) -> str:
    return f"({not_blank(x)} AND NOT {in_list(x, list(dict.fromkeys(vals)))})"


def enforce(x: str, vals, default: str | None) -> str:
    if default is None:
        return x
    return f"CASE WHEN {vocab_bad(x, vals)} THEN {q(default)} ELSE {x} END"


def fill(x: str, default: str | None) -> str:
    if default is None:
        return x
    return f"CASE WHEN {blank(x)} THEN {q(default)} ELSE {x} END"
