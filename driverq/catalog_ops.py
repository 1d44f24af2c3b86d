"""Driver queries for upload planning/accounting (ledger), the composite
validators (CMP-*) and the issue reports (AGG-10/11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from driverq import derive as D
from driverq import duck as Q
from driverq.catalog_fn import CONTACT, _date_column_sql
from driverq.catalog_rel import _FR, _PAIRS, BASE, FILES, _run_files
from driverq.registry import query
from manifestqc.functions.vocab import (
    DEFAULT_VALUES, PREPARE_FIELDS, PROJECT_ESSENTIAL, SAMPLE_ESSENTIAL, SAMPLE_FILL_FIELDS, VALID_OPTIONS,
)
from manifestqc.operators import issues as ISS
from manifestqc.operators import ledger as L
from manifestqc.operators.pairs import build_samples, detect_pairs, prepare_table
from manifestqc.operators.rows import assign_batches
from manifestqc.plans.upload import collect_files, upload_list
from manifestqc.plans.validate import clean_report, drop_blank_keys, validate_pair, validate_projects, validate_samples

CTE = D.duck_ctes()
W = f"WITH {CTE}, {_FR}"
BATCH = 50
FOLDER = "sub1"
CONFIG = {"default_values": {"library_strategy": "WGS", "platform": "ILLUMINA", "instrument_model": "unspecified",
                             "title": "untitled"},
          "contact": CONTACT}

# ------------------------------------------------------------- upload plan --
_PLAN = f"""FF AS (SELECT path, _row, col_pos, row_number() OVER (PARTITION BY path ORDER BY _row, col_pos) AS rn FROM VER WHERE found),
FILES AS (SELECT path, _row AS first_row, CAST(col_pos AS INTEGER) AS first_pos FROM FF WHERE rn = 1),
B0 AS (SELECT path, first_row, first_pos, row_number() OVER (ORDER BY first_row, first_pos) AS seq FROM FILES),
B AS (SELECT *, (seq - 1) // {BATCH} + 1 AS batch FROM B0),
EV AS (SELECT event_id AS attempt_no, user_id + 1 AS batch,
       CASE WHEN event_type = 'purchase' THEN event_id % {BATCH} + 1 END AS slot, event_type <> 'error' AS ok FROM events),
MEM AS (SELECT B.path, EV.attempt_no, EV.ok, EV.attempt_no AS ord FROM EV JOIN B ON EV.batch = B.batch WHERE EV.slot IS NULL
  UNION ALL SELECT B.path, EV.attempt_no, EV.ok, EV.attempt_no + 1000000000000 FROM EV JOIN B
  ON EV.batch = B.batch AND EV.slot = B.seq - (B.batch - 1) * {BATCH} WHERE EV.slot IS NOT NULL),
OUTC AS (SELECT path, CASE WHEN arg_max(ok, ord) THEN 'uploaded' ELSE 'failed' END AS status,
  arg_max(attempt_no, ord) AS attempt_no FROM MEM GROUP BY path),
MID AS (SELECT max(event_id) // 2 AS m FROM events)"""
WP = f"{W}, {_PLAN}"


def _files(spark, sf, materialized: bool = False):
    f = collect_files(D.sample_manifest(spark, sf), D.inventory(spark, sf), BASE, file_columns=FILES)
    if materialized:  # read several times below: cut the lineage once
        from manifestqc.session import materialize
        f = materialize(f)
    return f


def _batches(spark, sf, files=None):
    f = (files if files is not None else _files(spark, sf, materialized=True))
    return assign_batches(f, ["first_row", "first_pos"], BATCH, materialize_input=True)


def _attempts(spark, sf, batches):
    ev = D.table(spark, sf, "events").selectExpr(
        "event_id AS attempt_no", "user_id + 1 AS batch",
        f"CASE WHEN event_type = 'purchase' THEN event_id % {BATCH} + 1 END AS slot", "event_type <> 'error' AS ok")
    slots = batches.selectExpr("batch", f"seq - (batch - 1) * {BATCH} AS slot", "path")
    cols = ["attempt_no", "batch", "path", "ok"]
    per_file = ev.filter("slot IS NOT NULL").join(slots, ["batch", "slot"]).select(*cols)
    whole = ev.filter("slot IS NULL").withColumn("path", F.lit(None).cast("string")).select(*cols)
    return whole.unionByName(per_file)


def _outcomes(spark, sf, files=None):
    from manifestqc.session import materialize
    b = materialize(_batches(spark, sf, files))  # attempts and their outcomes both read it
    return L.reduce_attempts(_attempts(spark, sf, b), b)


def _ledger(spark, sf, files=None):
    from manifestqc.sources.ledger_store import empty_ledger
    return L.merge_ledger(empty_ledger(spark), _outcomes(spark, sf, files), FOLDER, "2024-01-01 00:00:00")


@query("collect_files", f"{WP} SELECT path, first_row, first_pos FROM FILES")
def q_collect_files(spark, sf):
    return _files(spark, sf)


@query("assign_batches", f"{WP} SELECT path, seq, batch FROM B")
def q_assign_batches(spark, sf):
    return _batches(spark, sf).select("path", "seq", "batch")


@query("reduce_attempts", f"{WP} SELECT path, status, attempt_no FROM OUTC")
def q_reduce_attempts(spark, sf):
    return _outcomes(spark, sf)


@query("ledger_merge", f"""{WP},
OLD AS (SELECT path, CASE WHEN arg_max(ok, ord) THEN 'uploaded' ELSE 'failed' END AS status
        FROM MEM, MID WHERE attempt_no < MID.m GROUP BY path),
NEW AS (SELECT path, CASE WHEN arg_max(ok, ord) THEN 'uploaded' ELSE 'failed' END AS status
        FROM MEM, MID WHERE attempt_no >= MID.m GROUP BY path)
SELECT '{FOLDER}' AS folder, coalesce(NEW.path, OLD.path) AS path, coalesce(NEW.status, OLD.status) AS status
FROM OLD FULL OUTER JOIN NEW ON OLD.path = NEW.path""")
def q_ledger_merge(spark, sf):
    from manifestqc.session import materialize
    b = materialize(_batches(spark, sf))  # read four times
    att = _attempts(spark, sf, b)
    mid = D.table(spark, sf, "events").agg((F.max("event_id") / 2).cast("long")).scalar()
    old = L.reduce_attempts(att.filter(F.col("attempt_no") < mid), b)
    new = L.reduce_attempts(att.filter(F.col("attempt_no") >= mid), b)
    from manifestqc.sources.ledger_store import empty_ledger
    old_ledger = L.merge_ledger(empty_ledger(spark), old, FOLDER, "2024-01-01 00:00:00")
    return L.merge_ledger(old_ledger, new, FOLDER, "2024-02-01 00:00:00").select("folder", "path", "status")


@query("pending_files", f"""{WP} SELECT path FROM FILES
WHERE NOT EXISTS (SELECT 1 FROM OUTC WHERE OUTC.path = FILES.path AND OUTC.status = 'uploaded')""")
def q_pending_files(spark, sf):
    f = _files(spark, sf, materialized=True)
    return L.pending_files(f, _ledger(spark, sf, f)).select("path")


@query("upload_summary", f"""{WP}, U AS (SELECT
  (SELECT CAST(count(*) AS BIGINT) FROM FILES) AS n_total,
  (SELECT CAST(count(*) AS BIGINT) FROM FILES WHERE path IN (SELECT path FROM OUTC WHERE status = 'uploaded')) AS n_uploaded,
  (SELECT CAST(count(*) AS BIGINT) FROM OUTC WHERE status = 'failed') AS n_failed)
SELECT n_total, n_uploaded, n_failed, n_uploaded = n_total AND n_failed = 0 AS all_uploaded FROM U""")
def q_upload_summary(spark, sf):
    f = _files(spark, sf, materialized=True)
    return L.upload_summary(f, _ledger(spark, sf, f))


@query("failed_list", f"{WP} SELECT path FROM OUTC WHERE status = 'failed' ORDER BY path")
def q_failed_list(spark, sf):
    return L.failed_list(_ledger(spark, sf))


@query("upload_list", f"{W} SELECT path, key, _row, \"column\" FROM FR")
def q_upload_list(spark, sf):
    return upload_list(D.sample_manifest(spark, sf), BASE)


# ------------------------------------------------------------- composites --
def _prepare_sql() -> str:
    d = CONFIG["default_values"]
    cols = [f if f in D.sample_columns("duck") else f"{Q.q(d.get(f, ''))} AS {f}" for f in PREPARE_FIELDS]
    cols += ["filename", "filename2",
             "CASE WHEN contains(title, 'Human') OR contains(title, 'Mouse') THEN 'host-associated' ELSE 'environmental' END AS sample_source",
             "CASE WHEN contains(title, 'Human') THEN 'Homo sapiens' WHEN contains(title, 'Mouse') THEN 'Mus musculus' ELSE '' END AS host",
             "CASE WHEN contains(title, 'Stool') THEN 'Stool' ELSE '' END AS isolation_source"]
    cols += [f"{Q.q(v)} AS contact_{k}" for k, v in CONTACT.items()]
    cols += ["'' AS bioproject_id", "'' AS biosample_id", "'Metagenomic sequencing' AS design_description"]
    return f"WITH {CTE} SELECT {', '.join(cols)} FROM S"


@query("prepare_table", _prepare_sql())
def q_prepare_table(spark, sf):
    return prepare_table(D.sample_manifest(spark, sf), CONFIG)


def _build_sql() -> str:
    d = CONFIG["default_values"]
    sn = Q.sample_from_file("file1")
    has2 = "(file2 IS NOT NULL AND file2 <> '')"
    cols = [f"{sn} AS sample_name", f"'Lib_' || {sn} AS library_ID", f"'Metagenome from ' || {sn} AS title",
            f"{Q.basename('file1')} AS filename", f"CASE WHEN {has2} THEN {Q.basename('file2')} ELSE '' END AS filename2",
            "file1 AS filepath", f"CASE WHEN {has2} THEN file2 ELSE '' END AS filepath2",
            f"CASE WHEN {has2} THEN 'paired' ELSE 'single' END AS library_layout",
            "'Metagenomic sequencing' AS design_description", "'fastq' AS filetype"]
    derived = {"sample_name", "library_ID", "title", "filename", "filename2", "filepath", "filepath2",
               "library_layout", "design_description", "filetype"}
    cols += [f"{Q.q(v)} AS {k}" for k, v in d.items() if k not in derived]
    cols += [f"{Q.q(v)} AS contact_{k}" for k, v in CONTACT.items()]
    cols += ["'' AS bioproject_id", "'' AS biosample_id"]
    return f"WITH {_PAIRS} SELECT {', '.join(cols)} FROM PAIRS"


@query("build_samples", _build_sql())
def q_build_samples(spark, sf):
    return build_samples(detect_pairs(_run_files(spark, sf)), CONFIG)


def _enf(f: str, expr: str) -> str:
    return Q.enforce(expr, VALID_OPTIONS[f], DEFAULT_VALUES.get(f))


def _validated_samples_sql(src: str) -> str:
    cols = ["sample_name", f"CASE WHEN {Q.blank('library_ID')} THEN sample_name ELSE library_ID END AS library_ID",
            "title"]
    cols += [f"{_enf(f, Q.fill(f, DEFAULT_VALUES.get(f)))} AS {f}" for f in SAMPLE_FILL_FIELDS]
    cols += [f"{_enf('library_layout', Q.layout('library_layout'))} AS library_layout",
             f"{_enf('filetype', 'filetype')} AS filetype", "filename", "filename2", "_row"]
    cols += [f"{Q.q(DEFAULT_VALUES.get(c, ''))} AS {c}" for c in SAMPLE_ESSENTIAL if c not in D.sample_columns("duck")]
    return f"""VS0 AS (SELECT {', '.join(cols)} FROM {src}),
VSL AS (SELECT max(CASE WHEN {Q.not_blank('sample_name')} THEN _row END) AS last FROM {src}),
VS AS (SELECT VS0.* FROM VS0, VSL WHERE VSL.last IS NULL OR VS0._row <= VSL.last)"""


@query("validate_samples", f"WITH {CTE}, {_validated_samples_sql('S')} SELECT * FROM VS")
def q_validate_samples(spark, sf):
    out, _ = validate_samples(D.sample_manifest(spark, sf))
    return out


_P_VOCAB = [f for f in VALID_OPTIONS if f in D.project_columns("duck")]


def _validated_projects_sql(src: str) -> str:
    pc = D.project_columns("duck")
    cols = ["sample_name", "project_title", f"{Q.source('sample_source')} AS sample_source",
            f"{_date_column_sql('collection_date', DEFAULT_VALUES['collection_date'])} AS collection_date",
            f"{Q.geo('geo_loc_name')} AS geo_loc_name", f"{Q.latlon('lat_lon')} AS lat_lon"]
    cols += [f"{_enf(f, Q.fill(f, DEFAULT_VALUES.get(f)))} AS {f}" for f in _P_VOCAB]
    cols += ["host", "filename", "_row", "_row + 1 AS file_number"]
    cols += [f"{Q.q(DEFAULT_VALUES.get(c, ''))} AS {c}" for c in PROJECT_ESSENTIAL if c not in pc]
    return f"""VP0 AS (SELECT {', '.join(cols)} FROM {src}),
VPL AS (SELECT max(CASE WHEN {Q.not_blank('sample_name')} THEN _row END) AS last FROM {src}),
VP AS (SELECT VP0.* FROM VP0, VPL WHERE VPL.last IS NULL OR VP0._row <= VPL.last)"""


@query("validate_projects", f"WITH {CTE}, {_validated_projects_sql('P')} SELECT * FROM VP")
def q_validate_projects(spark, sf):
    out, _ = validate_projects(D.project_manifest(spark, sf), materialize_input=True)
    return out


# ----------------------------------------------------------------- issues --
_S_DATA = [c for c in D.sample_columns("duck") if c != "sample_name"]
_P_DATA = [c for c in D.project_columns("duck") if c != "sample_name"]
_S_VOCAB = [f for f in VALID_OPTIONS if f in D.sample_columns("duck")]


def _common_issue_sql(src: str, tbl: str, data_cols) -> list[str]:
    """duplicate_keys, tail_data, missing_cells rows (rule, tbl, severity)."""
    nb = Q.not_blank("sample_name")
    tail = " UNION ALL ".join(
        f"SELECT 1 FROM {src}, (SELECT max(CASE WHEN {nb} THEN _row END) AS last FROM {src}) LL "
        f"WHERE LL.last IS NOT NULL AND _row > LL.last AND {Q.not_blank(c)}" for c in data_cols)
    miss = " UNION ALL ".join(
        f"SELECT 1 FROM (SELECT count_if({nb} AND {Q.blank(c)}) AS n FROM {src}) WHERE n > 0" for c in data_cols)
    return [
        f"""SELECT 'duplicate_keys' AS rule, '{tbl}' AS tbl, 'warning' AS severity FROM {src}
  JOIN (SELECT sample_name AS k FROM {src} WHERE sample_name IS NOT NULL GROUP BY sample_name HAVING count(*) > 1) DK
  ON {src}.sample_name = DK.k""",
        f"SELECT 'tail_data', '{tbl}', 'warning' FROM ({tail})",
        f"SELECT 'missing_cells', '{tbl}', 'info' FROM ({miss})",
    ]


def _sample_issue_sql(src: str, tbl: str = "sample") -> list[str]:
    lay = Q.layout("library_layout")
    vocab = []
    for f in _S_VOCAB:
        v = Q.fill(f, DEFAULT_VALUES.get(f)) if f in SAMPLE_FILL_FIELDS else (lay if f == "library_layout" else f)
        vocab.append(f"SELECT 'vocabulary', '{tbl}', 'warning' FROM {src} WHERE {Q.vocab_bad(v, VALID_OPTIONS[f])}")
    lay_v = _enf("library_layout", lay)
    mate = (f"SELECT 'layout_mate', '{tbl}', 'warning' FROM {src} WHERE ({lay_v} = 'paired' AND {Q.blank('filename2')}) "
            f"OR ({lay_v} = 'single' AND NOT {Q.blank('filename2')})")
    return _common_issue_sql(src, tbl, _S_DATA) + vocab + [mate]


def _project_issue_sql(src: str, tbl: str = "project") -> list[str]:
    vocab = [f"SELECT 'vocabulary', '{tbl}', 'warning' FROM {src} WHERE "
             f"{Q.vocab_bad(Q.fill(f, DEFAULT_VALUES.get(f)), VALID_OPTIONS[f])}" for f in _P_VOCAB]
    blank_date = f"SELECT 'blank_date', '{tbl}', 'warning' FROM {src} WHERE {Q.blank('collection_date')}"
    host = (f"SELECT 'host', '{tbl}', 'warning' FROM {src} WHERE {Q.source('sample_source')} = 'host-associated' "
            f"AND {Q.blank('host')}")
    return _common_issue_sql(src, tbl, _P_DATA) + [blank_date] + vocab + [host]


@query("issue_summary", f"""WITH {CTE}, X AS ({' UNION ALL '.join(_sample_issue_sql('S'))})
SELECT rule, severity, CAST(count(*) AS BIGINT) AS n_issues FROM X GROUP BY rule, severity""")
def q_issue_summary(spark, sf):
    # the table feeds every rule branch: checkpoint it once
    _, iss = validate_samples(D.sample_manifest(spark, sf), materialize_input=True)
    return ISS.issue_summary(iss)


_PAIR_MISS = f"""FRK0 AS (SELECT sample_name AS key, {Q.strip('filename')} AS file FROM SK0
  UNION ALL SELECT sample_name, {Q.strip('filename2')} FROM SK0),
FRK AS (SELECT key, {Q.resolve('file', BASE)} AS path FROM FRK0 WHERE file IS NOT NULL AND file <> '')"""


def _first(rel: str) -> str:
    return f"""(SELECT sample_name AS key, filename FROM (SELECT sample_name, filename,
   row_number() OVER (PARTITION BY sample_name ORDER BY _row) AS rn FROM {rel}) WHERE rn = 1)"""


def _pair_issues(drop: bool = False) -> str:
    """Issue rows of the pair; with ``drop`` samples with a missing file leave both tables first."""
    keep = "AND sample_name NOT IN (SELECT key FROM GONE)" if drop else ""
    missing = "'removed_sample' AS rule, 'sample' AS tbl, 'info'" if drop else "'missing_file' AS rule, 'sample' AS tbl, 'error'"
    return f"""SK0 AS (SELECT * FROM S WHERE {Q.not_blank('sample_name')}),
IV AS (SELECT DISTINCT path FROM I), {_PAIR_MISS},
GONE AS (SELECT key, path FROM FRK WHERE path NOT IN (SELECT path FROM IV)),
SK AS (SELECT * FROM SK0 WHERE true {keep}),
PK AS (SELECT * FROM P WHERE {Q.not_blank('sample_name')} {keep}),
FS AS (SELECT key, {Q.strip('filename')} AS a FROM {_first('SK')} WHERE NOT {Q.blank_t('filename')}),
FP AS (SELECT key, {Q.strip('filename')} AS b FROM {_first('PK')} WHERE NOT {Q.blank_t('filename')}),
KA AS (SELECT DISTINCT sample_name AS key FROM SK), KB AS (SELECT DISTINCT sample_name AS key FROM PK),
X AS (
  SELECT {missing} AS severity FROM GONE
  UNION ALL SELECT 'blank_key', 'sample', 'info' FROM S WHERE NOT {Q.not_blank('sample_name')}
  UNION ALL SELECT 'blank_key', 'project', 'info' FROM P WHERE NOT {Q.not_blank('sample_name')}
  UNION ALL SELECT 'filename_mismatch', 'both', 'warning' FROM FS JOIN FP ON FS.key = FP.key
    WHERE a <> b AND {Q.basename('a')} <> {Q.basename('b')}
  UNION ALL SELECT 'key_coverage', CASE WHEN KA.key IS NULL THEN 'project' ELSE 'sample' END, 'warning'
    FROM KA FULL OUTER JOIN KB ON KA.key = KB.key WHERE KA.key IS NULL OR KB.key IS NULL
  UNION ALL {' UNION ALL '.join(_project_issue_sql('PK'))}
  UNION ALL {' UNION ALL '.join(_sample_issue_sql('SK'))})"""


def one_table_sql() -> str:
    """Issue counts of the sample table alone after samples with a missing file are removed."""
    miss = _PAIR_MISS.replace("SK0", "S").replace("FRK0", "F1").replace("FRK", "F2")
    miss = miss.replace("FROM S)", "FROM READ_S)").replace("FROM S\n", "FROM READ_S\n")
    return f"""WITH {CTE}, IV AS (SELECT DISTINCT path FROM I), READ_S AS (SELECT * REPLACE (nullif(sample_name, '') AS sample_name) FROM S), {miss},
GONE AS (SELECT key, path FROM F2 WHERE path NOT IN (SELECT path FROM IV)),
LEFT_S AS (SELECT * FROM READ_S WHERE sample_name IS NULL OR sample_name NOT IN (SELECT key FROM GONE WHERE key IS NOT NULL)),
X AS (SELECT 'removed_sample' AS rule, 'sample' AS tbl, 'info' AS severity FROM GONE
  UNION ALL SELECT 'blank_key', 'sample', 'info' FROM S WHERE NOT {Q.not_blank('sample_name')}
  UNION ALL {' UNION ALL '.join(_sample_issue_sql('LEFT_S'))})
SELECT rule, tbl, severity, CAST(count(*) AS BIGINT) AS n_issues FROM X GROUP BY rule, tbl, severity"""


_BLOCKING = f"rule IN ({', '.join(Q.q(r) for r in ISS.STRICT_RULES)}) OR severity = 'error'"


@query("validate_pair", f"""WITH {CTE}, {_pair_issues()}
SELECT rule, tbl, severity, CAST(count(*) AS BIGINT) AS n_issues FROM X GROUP BY rule, tbl, severity""")
def q_validate_pair(spark, sf):
    _, _, iss = validate_pair(D.project_manifest(spark, sf), D.sample_manifest(spark, sf), None,
                              inventory=D.inventory(spark, sf), base=BASE, file_columns=FILES)
    return iss.groupBy("rule", "tbl", "severity").agg(F.count(F.lit(1)).cast("long").alias("n_issues"))


def _whole_issues(src: str, tbl: str) -> list[str]:
    """Issue rows of one table of the pair with every column: rule, tbl, col, key, row, value, message, severity."""
    def text(x: str) -> str:
        return f"CAST({x} AS VARCHAR)"

    def rule(name: str, field: str, value: str, message: str, where: str) -> str:
        return (f"SELECT '{name}' AS rule, '{tbl}' AS tbl, '{field}' AS col, sample_name AS key, _row AS row, {text(value)} AS value, "
                f"{message} AS message, 'warning' AS severity FROM {src} WHERE {where}")

    def off_list(field: str, value: str) -> str:
        d = DEFAULT_VALUES.get(field)
        said = Q.q("not in vocabulary, no default" if d is None else f"not in vocabulary, replaced by {d}")
        return rule("vocabulary", field, value, said, Q.vocab_bad(value, VALID_OPTIONS[field]))

    lay = Q.layout("library_layout")
    count = "count(*) OVER (PARTITION BY sample_name)"
    parts = [f"""SELECT 'duplicate_keys', '{tbl}', 'sample_name', sample_name, _row, {text('n')}, 'key occurs on ' || n || ' rows', 'warning'
  FROM (SELECT sample_name, _row, {count} AS n FROM {src}) WHERE n > 1"""]
    for c in _S_DATA if tbl == "sample" else _P_DATA:
        parts.append(f"""SELECT 'missing_cells', '{tbl}', '{c}', NULL, NULL, {text('n')}, 'blank on ' || n || ' keyed rows', 'info'
  FROM (SELECT count_if({Q.blank(c)}) AS n FROM {src}) WHERE n > 0""")
    if tbl == "sample":
        for f in _S_VOCAB:
            parts.append(off_list(f, Q.fill(f, DEFAULT_VALUES.get(f)) if f in SAMPLE_FILL_FIELDS else (lay if f == "library_layout" else f)))
        kept = _enf("library_layout", lay)
        parts.append(rule("layout_mate", "library_layout", "filename2", "'paired layout without a second file'", f"{kept} = 'paired' AND {Q.blank('filename2')}"))
        parts.append(rule("layout_mate", "library_layout", "filename2", "'single layout with a second file'", f"{kept} = 'single' AND NOT {Q.blank('filename2')}"))
    else:
        parts += [off_list(f, Q.fill(f, DEFAULT_VALUES.get(f))) for f in _P_VOCAB]
        parts.append(rule("blank_date", "collection_date", "collection_date", "'empty collection date'", Q.blank("collection_date")))
        parts.append(rule("host", "host", Q.source("sample_source"), "'host-associated sample without host'",
                          f"{Q.source('sample_source')} = 'host-associated' AND {Q.blank('host')}"))
    return parts


def _whole_pair_issues() -> str:
    ctes = _pair_issues().split("X AS (")[0].rstrip().rstrip(",")
    refs = " UNION ALL ".join(f"SELECT sample_name AS key, _row, '{c}' AS col, {Q.strip(c)} AS file FROM SK0" for c in FILES)
    blank = " UNION ALL ".join(
        f"SELECT 'blank_key', '{tbl}', 'sample_name', NULL, _row, NULL, 'row without a key is left out', 'info' FROM {src} WHERE NOT {Q.not_blank('sample_name')}"
        for src, tbl in (("S", "sample"), ("P", "project")))
    return f"""{ctes}, REFS AS (SELECT key, _row, col, {Q.resolve('file', BASE)} AS path FROM ({refs}) WHERE file IS NOT NULL AND file <> ''),
X AS (SELECT 'missing_file' AS rule, 'sample' AS tbl, col, key, _row AS row, path AS value, 'referenced file not found' AS message, 'error' AS severity
    FROM REFS WHERE path NOT IN (SELECT path FROM IV)
  UNION ALL {blank}
  UNION ALL SELECT 'filename_mismatch', 'both', 'filename', FS.key, NULL, a || ' | ' || b, 'file names differ between the tables', 'warning'
    FROM FS JOIN FP ON FS.key = FP.key WHERE a <> b AND {Q.basename('a')} <> {Q.basename('b')}
  UNION ALL SELECT 'key_coverage', t, 'sample_name', key, NULL, NULL, 'key only in the ' || t || ' table', 'warning'
    FROM (SELECT coalesce(KA.key, KB.key) AS key, CASE WHEN KA.key IS NULL THEN 'project' ELSE 'sample' END AS t
          FROM KA FULL OUTER JOIN KB ON KA.key = KB.key WHERE KA.key IS NULL OR KB.key IS NULL)
  UNION ALL {' UNION ALL '.join(_whole_issues('PK', 'project') + _whole_issues('SK', 'sample'))})"""


@query("pair_issues", f"WITH {CTE}, {_whole_pair_issues()} SELECT rule, tbl, col, key, CAST(row AS BIGINT) AS row, value, message, severity FROM X")
def q_pair_issues(spark, sf):
    return validate_pair(D.project_manifest(spark, sf), D.sample_manifest(spark, sf), None,
                         inventory=D.inventory(spark, sf), base=BASE, file_columns=FILES)[2]


@query("strict_gate_drop", f"""WITH {CTE}, {_pair_issues(drop=True)}
SELECT CAST(count_if({_BLOCKING}) AS BIGINT) AS n_blocking, count_if({_BLOCKING}) = 0 AS passed FROM X""")
def q_strict_gate_drop(spark, sf):
    _, _, iss = validate_pair(D.project_manifest(spark, sf), D.sample_manifest(spark, sf), None,
                              inventory=D.inventory(spark, sf), base=BASE, file_columns=FILES, on_missing="drop")
    return ISS.strict_gate(iss)


@query("strict_gate", f"""WITH {CTE}, {_pair_issues()}
SELECT CAST(count_if({_BLOCKING}) AS BIGINT) AS n_blocking, count_if({_BLOCKING}) = 0 AS passed FROM X""")
def q_strict_gate(spark, sf):
    _, _, iss = validate_pair(D.project_manifest(spark, sf), D.sample_manifest(spark, sf), None,
                              inventory=D.inventory(spark, sf), base=BASE, file_columns=FILES)
    return ISS.strict_gate(iss)


_CLEAN = f"""PK AS (SELECT * FROM P WHERE {Q.not_blank('sample_name')}),
IV AS (SELECT DISTINCT path FROM I),
CR0 AS (SELECT {Q.strip('filename')} AS file FROM S UNION ALL SELECT {Q.strip('filename2')} FROM S),
CR AS (SELECT {Q.resolve('file', BASE)} AS path FROM CR0 WHERE file IS NOT NULL AND file <> ''),
X AS (SELECT 'missing_file' AS rule, 'error' AS severity FROM CR WHERE path NOT IN (SELECT path FROM IV)
  UNION ALL SELECT 'count_parity', 'error' WHERE (SELECT count(*) FROM S) <> (SELECT count(*) FROM PK))"""


def _clean(spark, sf):
    p = drop_blank_keys(D.project_manifest(spark, sf))
    return clean_report(D.sample_manifest(spark, sf), p, D.inventory(spark, sf), BASE)


@query("clean_report", f"""WITH {CTE}, {_CLEAN}
SELECT rule, severity, CAST(count(*) AS BIGINT) AS n_issues FROM X GROUP BY rule, severity""")
def q_clean_report(spark, sf):
    iss, _ = _clean(spark, sf)
    return ISS.issue_summary(iss)


@query("verdict", f"""WITH {CTE}, {_CLEAN}, WR AS (SELECT max(CASE severity WHEN 'error' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END) AS w FROM X)
SELECT CASE WHEN w = 2 THEN 'fail' WHEN w = 1 THEN 'pass_with_warnings' ELSE 'pass' END AS verdict,
  CAST(coalesce(w, 0) AS BIGINT) AS worst_rank FROM WR""")
def q_verdict(spark, sf):
    _, v = _clean(spark, sf)
    return v
