"""Driver queries for the scalar functions (FN-*) and column rules (PRJ-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from driverq import derive as D
from driverq import duck as Q
from driverq.registry import query
from manifestqc.functions import (
    apply_na_tokens, basename, destination_path, expected_mate, infer_host, infer_isolation_source,
    infer_sample_source, is_blank, is_blank_trimmed, is_sequence_file, mate_name, normalize_date,
    normalize_geo, normalize_latlon, resolve_path, safe_name, sample_name_from_file, transfer_ok,
)
from manifestqc.functions.blank import DEFAULT_NA_TOKENS
from manifestqc.functions.paths import DEFAULT_FOLDER
from manifestqc.functions.vocab import (
    DEFAULT_VALUES, PREPARE_FIELDS, SAMPLE_ESSENTIAL, SAMPLE_FILL_FIELDS, VALID_OPTIONS,
    extend_vocabulary,
)
from manifestqc.operators import rules as U
from manifestqc.operators.rows import trim_tail
from manifestqc.operators.sorts import preview
from manifestqc.sources.config import overlay_frames

OC = D.DUCK_OC
CTE = D.duck_ctes()


def _oc_text(spark, sf, expr_spark: str):
    return D.orders_customer(spark, sf).selectExpr("o_orderkey", f"{expr_spark} AS raw")


# ------------------------------------------------------------------ dates --
@query("normalize_date", f"""WITH {OC}, T AS (SELECT o_orderkey, {D.date_text('duck')} AS raw FROM OC)
SELECT o_orderkey, raw, {Q.date('raw')} AS normalized FROM T""")
def q_normalize_date(spark, sf):
    t = _oc_text(spark, sf, D.date_text("spark"))
    return t.select("o_orderkey", "raw", normalize_date(F.col("raw")).alias("normalized"))


@query("normalize_date_strict", f"""WITH {OC}, T AS (SELECT o_orderkey, {D.date_text('duck')} AS raw FROM OC)
SELECT o_orderkey, raw, {Q.date('raw', strict=True)} AS normalized FROM T""")
def q_normalize_date_strict(spark, sf):
    t = _oc_text(spark, sf, D.date_text("spark"))
    return t.select("o_orderkey", "raw", normalize_date(F.col("raw"), strict=True).alias("normalized"))


@query("normalize_geo", f"""WITH {OC}, T AS (SELECT o_orderkey, {D.geo_text('duck')} AS raw FROM OC)
SELECT o_orderkey, raw, {Q.geo('raw')} AS normalized FROM T""")
def q_normalize_geo(spark, sf):
    t = _oc_text(spark, sf, D.geo_text("spark"))
    return t.select("o_orderkey", "raw", normalize_geo(F.col("raw")).alias("normalized"))


@query("normalize_latlon", f"""WITH {OC}, T AS (SELECT o_orderkey, {D.latlon_text('duck')} AS raw FROM OC)
SELECT o_orderkey, raw, {Q.latlon('raw')} AS normalized FROM T""")
def q_normalize_latlon(spark, sf):
    t = _oc_text(spark, sf, D.latlon_text("spark"))
    return t.select("o_orderkey", "raw", normalize_latlon(F.col("raw")).alias("normalized"))


# ----------------------------------------------------------------- paths --
@query("basename", f"SELECT page_id, url, {Q.basename('url')} AS base FROM pages")
def q_basename(spark, sf):
    p = D.table(spark, sf, "pages").select("page_id", "url")
    return p.select("page_id", "url", basename(F.col("url")).alias("base"))


@query("resolve_path", f"""WITH T AS (SELECT o_orderkey, {D.sample_file2()} AS raw FROM orders)
SELECT o_orderkey, raw, {Q.resolve(Q.strip('raw'), D.BASE_DIR)} AS resolved FROM T""")
def q_resolve_path(spark, sf):
    t = D.table(spark, sf, "orders").selectExpr("o_orderkey", f"{D.sample_file2()} AS raw")
    return t.select("o_orderkey", "raw", resolve_path(F.col("raw"), D.BASE_DIR).alias("resolved"))


def _shapes(spark, sf):
    return D.table(spark, sf, "orders").selectExpr("o_orderkey", f"{D.file_shape('spark')} AS raw")


_SHAPES = f"WITH T AS (SELECT o_orderkey, {D.file_shape('duck')} AS raw FROM orders)"


@query("mate_name", f"{_SHAPES} SELECT o_orderkey, raw, {Q.mate_name('raw')} AS mate FROM T")
def q_mate_name(spark, sf):
    return _shapes(spark, sf).select("o_orderkey", "raw", mate_name(F.col("raw")).alias("mate"))


@query("expected_mate", f"{_SHAPES} SELECT o_orderkey, raw, {Q.expected_mate(Q.basename('raw'))} AS expected FROM T")
def q_expected_mate(spark, sf):
    return _shapes(spark, sf).select("o_orderkey", "raw", expected_mate(basename(F.col("raw"))).alias("expected"))


@query("sample_name", f"{_SHAPES} SELECT o_orderkey, raw, {Q.sample_from_file('raw')} AS sample FROM T")
def q_sample_name(spark, sf):
    return _shapes(spark, sf).select("o_orderkey", "raw", sample_name_from_file(F.col("raw")).alias("sample"))


_SUFFIX = """'ord' || CAST(o_orderkey AS STRING) || CASE o_orderkey % 6 WHEN 0 THEN '.fastq'
  WHEN 1 THEN '.fq.gz' WHEN 2 THEN '.FASTQ' WHEN 3 THEN '.fastq.gz.bak' WHEN 4 THEN '.txt' ELSE '.fq' END"""


@query("is_sequence_file", rf"""SELECT o_orderkey, {_SUFFIX} AS raw,
  regexp_matches({_SUFFIX}, '\.(fastq|fq)(\.gz)?$') AS is_seq FROM orders""")
def q_is_sequence_file(spark, sf):
    t = D.table(spark, sf, "orders").selectExpr("o_orderkey", f"{_SUFFIX} AS raw")
    return t.select("o_orderkey", "raw", is_sequence_file(F.col("raw")).alias("is_seq"))


_FOLDER = "CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE c_name || ' run/' || c_mktsegment END"
_DEST = "'dest/' || c_mktsegment || repeat('/', CAST(c_custkey % 3 AS INTEGER))"


def _duck_safe(x):
    return rf"regexp_replace(CASE WHEN {Q.blank(x)} THEN {Q.q(DEFAULT_FOLDER)} ELSE {x} END, '[^A-Za-z0-9_.\-]', '_', 'g')"


@query("safe_name", f"SELECT c_custkey, {_FOLDER} AS raw, {_duck_safe(_FOLDER)} AS folder FROM customer")
def q_safe_name(spark, sf):
    c = D.table(spark, sf, "customer").selectExpr("c_custkey", f"{_FOLDER} AS raw")
    return c.select("c_custkey", "raw", safe_name(F.col("raw")).alias("folder"))


@query("destination_path", f"""SELECT c_custkey,
  regexp_replace({_DEST}, '/+$', '') || '/' || {_duck_safe(_FOLDER)} AS destination FROM customer""")
def q_destination_path(spark, sf):
    c = D.table(spark, sf, "customer").selectExpr("c_custkey", f"{_FOLDER} AS raw", f"{_DEST} AS dest")
    return c.select("c_custkey", destination_path(F.col("dest"), safe_name(F.col("raw"))).alias("destination"))


_EXIT = "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END"
_LOG = """CASE event_id % 6 WHEN 0 THEN 'done' WHEN 1 THEN 'Session Stop (Error)'
  WHEN 2 THEN CAST(event_id % 3 AS STRING) || ' files failed'
  WHEN 3 THEN '0 files failed then ' || CAST(event_id % 4 AS STRING) || ' FILES FAILED'
  WHEN 4 THEN 'Completed: 1 File Failed' ELSE NULL END"""


@query("transfer_outcome", rf"""WITH T AS (SELECT event_id, {_EXIT} AS exit_code, {_LOG} AS output FROM events)
SELECT event_id, exit_code, output,
  NOT (exit_code <> 0 OR contains(coalesce(output, ''), 'Session Stop')
       OR regexp_matches(regexp_extract(coalesce(output, ''), '(?i)(\d+)\s+files?\s+failed', 1), '[1-9]')) AS ok
FROM T""")
def q_transfer_outcome(spark, sf):
    e = D.table(spark, sf, "events").selectExpr("event_id", f"{_EXIT} AS exit_code", f"{_LOG} AS output")
    return e.select("event_id", "exit_code", "output", transfer_ok(F.col("exit_code"), F.col("output")).alias("ok"))


_CELL = """CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' '
  WHEN 3 THEN ' ' || chr(9) || ' ' WHEN 4 THEN chr(9) || 'x' ELSE o_orderpriority END"""


@query("is_blank", f"""WITH T AS (SELECT o_orderkey, {_CELL} AS v FROM orders)
SELECT o_orderkey, {Q.blank('v')} AS blank, {Q.blank_t('v')} AS blank_trimmed FROM T""")
def q_is_blank(spark, sf):
    t = D.table(spark, sf, "orders").selectExpr("o_orderkey", f"{_CELL} AS v")
    return t.select("o_orderkey", is_blank(F.col("v")).alias("blank"),
                    is_blank_trimmed(F.col("v")).alias("blank_trimmed"))


_NA = """CASE o_orderkey % 7 WHEN 0 THEN 'NA' WHEN 1 THEN 'n/a' WHEN 2 THEN 'NULL' WHEN 3 THEN 'None'
  WHEN 4 THEN '' WHEN 5 THEN 'na' ELSE o_orderstatus END"""


@query("na_tokens", f"""WITH T AS (SELECT o_orderkey, {_NA} AS v FROM orders)
SELECT o_orderkey, v, CASE WHEN {Q.in_list('v', DEFAULT_NA_TOKENS)} THEN NULL ELSE v END AS cell FROM T""")
def q_na_tokens(spark, sf):
    t = D.table(spark, sf, "orders").selectExpr("o_orderkey", f"{_NA} AS v")
    return t.select("o_orderkey", "v", apply_na_tokens(F.col("v"), DEFAULT_NA_TOKENS).alias("cell"))


# ------------------------------------------------------------------ rules --
def _fill_sql(src: str, fields, defaults) -> str:
    return ", ".join(f"{Q.fill(f, defaults.get(f))} AS {f}" for f in fields)


@query("fill_defaults", f"WITH {CTE} SELECT _row, {_fill_sql('S', SAMPLE_FILL_FIELDS, DEFAULT_VALUES)} FROM S")
def q_fill_defaults(spark, sf):
    s = D.sample_manifest(spark, sf)
    return U.fill_defaults(s, SAMPLE_FILL_FIELDS, DEFAULT_VALUES).select("_row", *SAMPLE_FILL_FIELDS)


@query("fill_from_column", f"WITH {CTE} SELECT _row, CASE WHEN {Q.blank('library_ID')} THEN sample_name ELSE library_ID END AS library_ID FROM S")
def q_fill_from_column(spark, sf):
    return U.fill_from_column(D.sample_manifest(spark, sf), "library_ID", "sample_name").select("_row", "library_ID")


FLAG_MAP = {"library_strategy": "WGS", "platform": "ILLUMINA", "instrument_model": "unspecified"}


@query("fill_map_flag", f"""WITH {CTE} SELECT _row, {_fill_sql('S', list(FLAG_MAP), FLAG_MAP)},
  ({' OR '.join(Q.blank(c) for c in FLAG_MAP)}) AS _fixed FROM S""")
def q_fill_map_flag(spark, sf):
    out = U.fill_map_flag(D.sample_manifest(spark, sf), FLAG_MAP)
    return out.select("_row", *FLAG_MAP, "_fixed")


def _blank_count_sql(rel: str, fields, defaults) -> str:
    parts = []
    for f in fields:
        after = Q.fill(f, defaults.get(f))
        parts.append(f"""SELECT '{f}' AS col, CAST(count_if({Q.blank(f)}) AS BIGINT) AS n_blank_before,
  CAST(count_if({Q.blank(after)}) AS BIGINT) AS n_blank_after FROM {rel}""")
    return " UNION ALL ".join(parts)


@query("fill_counts", f"""WITH {CTE}, B AS ({_blank_count_sql('S', SAMPLE_FILL_FIELDS, DEFAULT_VALUES)})
SELECT col, n_blank_before, n_blank_after, n_blank_before - n_blank_after AS n_filled FROM B""")
def q_fill_counts(spark, sf):
    s = D.sample_manifest(spark, sf)
    return U.fill_counts(s, SAMPLE_FILL_FIELDS, DEFAULT_VALUES)


_SUPPLIER_COLS = ["s_name AS sample_name", "CAST(s_suppkey AS STRING) AS library_ID",
                  "CASE WHEN s_acctbal < 0 THEN 'AMPLICON' ELSE '' END AS library_strategy",
                  "CASE s_nationkey % 3 WHEN 0 THEN 'PCR' WHEN 1 THEN NULL ELSE 'RANDOM' END AS library_selection"]
_SUPPLIER_MANIFEST = ", ".join(_SUPPLIER_COLS)


def _supplier_manifest(spark, sf):
    return D.table(spark, sf, "supplier").selectExpr("s_suppkey", *_SUPPLIER_COLS)


@query("ensure_columns", f"""SELECT s_suppkey, {_SUPPLIER_MANIFEST},
  {', '.join(Q.q(DEFAULT_VALUES.get(c, '')) + ' AS ' + c for c in SAMPLE_ESSENTIAL if c not in ('sample_name', 'library_ID', 'library_strategy', 'library_selection'))}
FROM supplier""")
def q_ensure_columns(spark, sf):
    return U.ensure_columns(_supplier_manifest(spark, sf), SAMPLE_ESSENTIAL, DEFAULT_VALUES)


@query("project_to_schema", f"""WITH T AS (SELECT s_suppkey, {_SUPPLIER_MANIFEST} FROM supplier)
SELECT {', '.join(c if c in ('sample_name', 'library_ID', 'library_strategy', 'library_selection') else Q.q(DEFAULT_VALUES.get(c, '')) + ' AS ' + c for c in PREPARE_FIELDS)} FROM T""")
def q_project_to_schema(spark, sf):
    return U.project_to_schema(_supplier_manifest(spark, sf), PREPARE_FIELDS, DEFAULT_VALUES)


CONTACT = {"name": "Data Desk", "email": "desk@example.org", "organization": "Example Lab"}
CONSTANTS = {**U.contact_columns(CONTACT), "bioproject_id": "PRJNA000001", "biosample_id": "",
             "design_description": "Metagenomic sequencing"}


@query("constant_columns", f"""SELECT s_suppkey, {_SUPPLIER_MANIFEST},
  {', '.join(Q.q(v) + ' AS ' + k for k, v in CONSTANTS.items())} FROM supplier""")
def q_constant_columns(spark, sf):
    return U.constant_columns(_supplier_manifest(spark, sf), CONSTANTS)


@query("overlay_defaults", """WITH SYS AS (SELECT CAST(p_partkey AS STRING) AS key, p_name AS value FROM part),
CUS AS (SELECT CAST(p_partkey AS STRING) AS key, p_brand AS value FROM part WHERE p_size > 25
        UNION ALL SELECT 'S' || CAST(s_suppkey AS STRING), s_name FROM supplier)
SELECT coalesce(SYS.key, CUS.key) AS key, coalesce(CUS.value, SYS.value) AS value
FROM SYS FULL OUTER JOIN CUS ON SYS.key = CUS.key""")
def q_overlay_defaults(spark, sf):
    part = D.table(spark, sf, "part")
    system = part.selectExpr("CAST(p_partkey AS STRING) AS key", "p_name AS value")
    custom = part.filter("p_size > 25").selectExpr("CAST(p_partkey AS STRING) AS key", "p_brand AS value") \
        .unionByName(D.table(spark, sf, "supplier").selectExpr("'S' || CAST(s_suppkey AS STRING) AS key",
                                                               "s_name AS value"))
    return overlay_frames(system, custom)


PRIORITY_VOCAB = {"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}
PRIORITY_DEFAULT = {"o_orderpriority": "3-MEDIUM"}


@query("vocab_replace", f"""SELECT o_orderkey, {Q.enforce('o_orderpriority', PRIORITY_VOCAB['o_orderpriority'], '3-MEDIUM')} AS o_orderpriority FROM orders""")
def q_vocab_replace(spark, sf):
    o = D.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return U.enforce_vocab(o, PRIORITY_VOCAB, PRIORITY_DEFAULT)


EXTENDED = extend_vocabulary(PRIORITY_VOCAB, "o_orderpriority", "4-NOT SPECIFIED")


@query("vocab_extend", f"""SELECT o_orderkey, {Q.enforce('o_orderpriority', EXTENDED['o_orderpriority'], '3-MEDIUM')} AS o_orderpriority FROM orders""")
def q_vocab_extend(spark, sf):
    o = D.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return U.enforce_vocab(o, EXTENDED, PRIORITY_DEFAULT)


def _violations_sql(rel: str, options, fields) -> str:
    parts = [f"SELECT '{f}' AS field, {f} AS value FROM {rel} WHERE {Q.vocab_bad(f, options[f])}"
             for f in fields if f in options]
    return f"SELECT field, value, CAST(count(*) AS BIGINT) AS n_rows FROM ({' UNION ALL '.join(parts)}) GROUP BY field, value"


_S_VOCAB = [f for f in VALID_OPTIONS if f in D.sample_columns("duck")]


@query("vocab_violations", f"WITH {CTE} {_violations_sql('S', VALID_OPTIONS, _S_VOCAB)}")
def q_vocab_violations(spark, sf):
    return U.vocab_violations(D.sample_manifest(spark, sf), VALID_OPTIONS)


@query("canonical_layout", f"WITH {CTE} SELECT _row, {Q.layout('library_layout')} AS library_layout FROM S")
def q_canonical_layout(spark, sf):
    return U.canonical_layout(D.sample_manifest(spark, sf)).select("_row", "library_layout")


@query("canonical_source", f"WITH {CTE} SELECT _row, {Q.source('sample_source')} AS sample_source FROM P")
def q_canonical_source(spark, sf):
    return U.canonical_source(D.project_manifest(spark, sf)).select("_row", "sample_source")


@query("drop_blank_keys", f"WITH {CTE} SELECT _row, sample_name FROM S WHERE {Q.not_blank('sample_name')}")
def q_drop_blank_keys(spark, sf):
    from manifestqc.plans.validate import drop_blank_keys
    return drop_blank_keys(D.sample_manifest(spark, sf)).select("_row", "sample_name")


@query("trim_tail", f"""WITH {CTE}, L AS (SELECT max(CASE WHEN {Q.not_blank('sample_name')} THEN _row END) AS last FROM S)
SELECT _row, sample_name FROM S, L WHERE L.last IS NULL OR S._row <= L.last""")
def q_trim_tail(spark, sf):
    return trim_tail(D.sample_manifest(spark, sf), "sample_name").select("_row", "sample_name")


_TITLE = """p_name || ' ' || CASE p_partkey % 5 WHEN 0 THEN 'Human' WHEN 1 THEN 'Mouse'
  WHEN 2 THEN 'Stool' WHEN 3 THEN 'Human Mouse Stool' ELSE p_type END"""


@query("keyword_infer", f"""WITH T AS (SELECT p_partkey, {_TITLE} AS title FROM part)
SELECT p_partkey, title,
  CASE WHEN contains(title, 'Human') OR contains(title, 'Mouse') THEN 'host-associated' ELSE 'environmental' END AS sample_source,
  CASE WHEN contains(title, 'Human') THEN 'Homo sapiens' WHEN contains(title, 'Mouse') THEN 'Mus musculus' ELSE '' END AS host,
  CASE WHEN contains(title, 'Stool') THEN 'Stool' ELSE '' END AS isolation_source FROM T""")
def q_keyword_infer(spark, sf):
    t = D.table(spark, sf, "part").selectExpr("p_partkey", f"{_TITLE} AS title")
    return t.select("p_partkey", "title", infer_sample_source("title").alias("sample_source"),
                    infer_host("title").alias("host"), infer_isolation_source("title").alias("isolation_source"))


def _date_column_sql(x: str, default: str | None) -> str:
    filled = Q.fill(x, default)
    guard = Q.blank_t(filled) + (f" OR ({filled}) = {Q.q(default)}" if default is not None else "")
    return f"CASE WHEN {guard} THEN {filled} ELSE {Q.date(filled)} END"


@query("date_column", f"WITH {CTE} SELECT _row, {_date_column_sql('collection_date', 'not collected')} AS collection_date FROM P")
def q_date_column(spark, sf):
    return U.date_column(D.project_manifest(spark, sf), "collection_date", "not collected") \
        .select("_row", "collection_date")


@query("date_column_strict", f"WITH {CTE} SELECT _row, {Q.date('collection_date', strict=True)} AS collection_date FROM P")
def q_date_column_strict(spark, sf):
    return U.date_column_strict(D.project_manifest(spark, sf)).select("_row", "collection_date")


@query("geo_column", f"WITH {CTE} SELECT _row, {Q.geo('geo_loc_name')} AS geo_loc_name FROM P")
def q_geo_column(spark, sf):
    return U.geo_column(D.project_manifest(spark, sf)).select("_row", "geo_loc_name")


@query("latlon_column", f"WITH {CTE} SELECT _row, {Q.latlon('lat_lon')} AS lat_lon FROM P")
def q_latlon_column(spark, sf):
    return U.latlon_column(D.project_manifest(spark, sf)).select("_row", "lat_lon")


_LAY = Q.layout("library_layout")


@query("layout_mate_rule", f"""WITH {CTE}, T AS (SELECT sample_name, _row, {_LAY} AS lay, filename2 FROM S)
SELECT sample_name AS key, _row AS row,
  CASE WHEN lay = 'paired' AND {Q.blank('filename2')} THEN 'paired layout without a second file'
       ELSE 'single layout with a second file' END AS message
FROM T WHERE (lay = 'paired' AND {Q.blank('filename2')}) OR (lay = 'single' AND NOT {Q.blank('filename2')})""")
def q_layout_mate_rule(spark, sf):
    s = U.canonical_layout(D.sample_manifest(spark, sf))
    return U.layout_mate_issues(s, "sample").select("key", "row", "message")


@query("host_rule", f"""WITH {CTE}, T AS (SELECT sample_name, _row, {Q.source('sample_source')} AS src, host FROM P)
SELECT sample_name AS key, _row AS row FROM T WHERE src = 'host-associated' AND {Q.blank('host')}""")
def q_host_rule(spark, sf):
    p = U.canonical_source(D.project_manifest(spark, sf))
    return U.host_issues(p, "project").select("key", "row")


@query("blank_date_rows", f"""WITH {CTE}, B AS (SELECT _row FROM P WHERE {Q.blank('collection_date')})
SELECT _row, (SELECT CAST(count(*) AS BIGINT) FROM B) AS n_blank FROM B ORDER BY _row LIMIT 10""")
def q_blank_date_rows(spark, sf):
    p = D.project_manifest(spark, sf)
    blanks = U.blank_date_issues(p, "project").select(F.col("row").alias("_row"))
    # The report lists the first 10 rows (a preview is the feature) and the whole count.
    return preview(blanks, ["_row"], 10, total_name="n_blank")


REQUIRED = ["sample_name", "library_ID", "filename", "filename2", "filepath"]


@query("required_columns", f"""WITH {CTE}
SELECT 'sample_name' AS col, true AS present, CAST(count_if({Q.not_blank('sample_name')}) AS BIGINT) AS n_nonblank FROM S
UNION ALL SELECT 'library_ID', true, CAST(count_if({Q.not_blank('library_ID')}) AS BIGINT) FROM S
UNION ALL SELECT 'filename', true, CAST(count_if({Q.not_blank('filename')}) AS BIGINT) FROM S
UNION ALL SELECT 'filename2', true, CAST(count_if({Q.not_blank('filename2')}) AS BIGINT) FROM S
UNION ALL SELECT 'filepath', false, CAST(0 AS BIGINT)""")
def q_required_columns(spark, sf):
    s = D.sample_manifest(spark, sf)
    missing = U.required_column_issues(s, REQUIRED, "sample")
    present = [c for c in REQUIRED if c in s.columns]
    counts = s.agg(*[F.count_if(F.col(c).isNotNull() & (F.col(c) != "")).cast("long").alias(c) for c in present])
    pairs = ", ".join(f"'{c}', true, `{c}`" for c in present)
    rows = counts.selectExpr(f"stack({len(present)}, {pairs}) as (col, present, n_nonblank)")
    return rows.unionByName(missing.selectExpr("col", "false AS present", "CAST(0 AS BIGINT) AS n_nonblank"))
