"""Driver queries for joins (JN-*), aggregates (AGG-*), windows (WN-*),
previews (SRT-*) and key sets (SET-*), over the derived sample table S,
project table P and inventory I."""

from __future__ import annotations


from driverq import derive as D
from driverq import duck as Q
from driverq.registry import query
from manifestqc.functions.vocab import DEFAULT_VALUES, VALID_OPTIONS
from manifestqc.operators import reconcile as R
from manifestqc.operators import rules as U
from manifestqc.operators.pairs import detect_pairs
from manifestqc.operators.rows import assign_batches, dense_number, first_per_key
from manifestqc.operators.sorts import preview, preview_per_group

CTE = D.duck_ctes()
BASE = D.BASE_DIR
FILES = ["filename", "filename2"]

# DuckDB: file references of S and the inventory as a distinct path set.
_FR = f"""FR0 AS (
  SELECT sample_name AS key, _row, 'filename' AS "column", 0 AS col_pos, {Q.strip('filename')} AS file FROM S
  UNION ALL SELECT sample_name, _row, 'filename2', 1, {Q.strip('filename2')} FROM S),
FR AS (SELECT key, _row, "column", col_pos, file, {Q.resolve('file', BASE)} AS path
       FROM FR0 WHERE file IS NOT NULL AND file <> ''),
IV AS (SELECT DISTINCT path FROM I),
MISS AS (SELECT * FROM FR WHERE NOT EXISTS (SELECT 1 FROM IV WHERE IV.path = FR.path)),
VER AS (SELECT FR.*, IV.path IS NOT NULL AS found FROM FR LEFT JOIN IV ON FR.path = IV.path)"""
W = f"WITH {CTE}, {_FR}"


def _refs(spark, sf):
    return R.file_refs(D.sample_manifest(spark, sf), "sample_name", FILES, BASE)


def _missing(spark, sf):
    return R.missing_files(_refs(spark, sf), D.inventory(spark, sf))


def _verified(spark, sf):
    return R.verify_files(_refs(spark, sf), D.inventory(spark, sf))


@query("file_refs", f'{W} SELECT key, _row, "column", col_pos, file, path FROM FR')
def q_file_refs(spark, sf):
    return _refs(spark, sf).select("key", "_row", "column", "col_pos", "file", "path")


@query("missing_files", f'{W} SELECT key, _row, "column", path FROM MISS')
def q_missing_files(spark, sf):
    return _missing(spark, sf).select("key", "_row", "column", "path")


@query("verify_files", f'{W} SELECT key, _row, "column", path, found FROM VER')
def q_verify_files(spark, sf):
    return _verified(spark, sf).select("key", "_row", "column", "path", "found")


@query("missing_by_sample", f"""{W} SELECT key, CAST(count(*) AS BIGINT) AS n_missing, min(path) AS first_missing,
  max(path) AS last_missing FROM MISS GROUP BY key""")
def q_missing_by_sample(spark, sf):
    return R.missing_by_sample(_missing(spark, sf))


@query("file_counts", f"""{W} SELECT CAST(count_if(found) AS BIGINT) AS n_found, CAST(count_if(NOT found) AS BIGINT) AS n_missing,
  CAST(count(DISTINCT CASE WHEN NOT found THEN key END) AS BIGINT) AS n_samples_missing,
  count_if(NOT found) = 0 AS all_exist FROM VER""")
def q_file_counts(spark, sf):
    return R.file_counts(_verified(spark, sf))


@query("remove_samples", f"""{W} SELECT _row, sample_name FROM S
WHERE NOT EXISTS (SELECT 1 FROM MISS WHERE MISS.key = S.sample_name)""")
def q_remove_samples(spark, sf):
    s = D.sample_manifest(spark, sf)
    bad = _missing(spark, sf).select("key").distinct()
    return R.remove_samples(s, bad, "sample_name").select("_row", "sample_name")


_ORD = "'ord' || CAST(o_orderkey AS STRING)"


def _orders_keyed(spark, sf):
    return D.table(spark, sf, "orders").selectExpr("o_orderkey", f"{_ORD} AS sample_name")


_DERIVED = f"""DP AS (SELECT {_ORD} AS key, '{BASE}/' || {_ORD} || '_R1.fastq.gz' AS path, 'R1' AS mate FROM orders
  UNION ALL SELECT {_ORD}, '{BASE}/' || {_ORD} || '_R2.fastq.gz', 'R2' FROM orders)"""


@query("complete_pairs", f"""WITH {CTE}, IV AS (SELECT DISTINCT path FROM I), {_DERIVED},
OK AS (SELECT key FROM DP WHERE path IN (SELECT path FROM IV) GROUP BY key HAVING count(DISTINCT mate) = 2)
SELECT o_orderkey FROM orders WHERE {_ORD} IN (SELECT key FROM OK)""")
def q_complete_pairs(spark, sf):
    o = _orders_keyed(spark, sf)
    keys = R.complete_pair_keys(o, "sample_name", D.inventory(spark, sf), base=BASE)
    return R.keep_keys(o, keys, "sample_name").select("o_orderkey")


@query("derived_files", f"""WITH {CTE}, IV AS (SELECT DISTINCT path FROM I), {_DERIVED}
SELECT CAST(count_if(IV.path IS NOT NULL) AS BIGINT) AS n_found, CAST(count_if(IV.path IS NULL) AS BIGINT) AS n_missing,
  CAST(count(*) AS BIGINT) AS n_expected FROM DP LEFT JOIN IV ON DP.path = IV.path""")
def q_derived_files(spark, sf):
    return R.derived_files(_orders_keyed(spark, sf), "sample_name", D.inventory(spark, sf), base=BASE)


def _first(rel: str) -> str:
    return f"""(SELECT sample_name AS key, filename FROM (SELECT sample_name, filename,
   row_number() OVER (PARTITION BY sample_name ORDER BY _row) AS rn FROM {rel} WHERE sample_name IS NOT NULL) WHERE rn = 1)"""


@query("filename_mismatch", f"""WITH {CTE},
FS AS (SELECT key, {Q.strip('filename')} AS sample_file FROM {_first('S')} WHERE NOT {Q.blank_t('filename')}),
FP AS (SELECT key, {Q.strip('filename')} AS project_file FROM {_first('P')} WHERE NOT {Q.blank_t('filename')})
SELECT FS.key, 'filename' AS "column", sample_file, project_file FROM FS JOIN FP ON FS.key = FP.key
WHERE sample_file <> project_file AND {Q.basename('sample_file')} <> {Q.basename('project_file')}""")
def q_filename_mismatch(spark, sf):
    return R.filename_mismatch(D.sample_manifest(spark, sf), D.project_manifest(spark, sf), "sample_name", FILES) \
        .select("key", "column", "sample_file", "project_file")


_RUN_FILE = """'/run' || CAST(l_linenumber % 2 AS STRING) || '/ord' || CAST(l_orderkey AS STRING) ||
  CASE l_linenumber WHEN 1 THEN '_R1.fastq.gz' WHEN 2 THEN '_R2.fastq.gz' WHEN 3 THEN '_1.fq' WHEN 4 THEN '_2.fq'
  WHEN 5 THEN '_forward.fq' WHEN 6 THEN '_reverse.fq' ELSE '_f.fq' END"""


def _run_files(spark, sf):
    return D.table(spark, sf, "lineitem").selectExpr(f"{_RUN_FILE} AS path")


_PAIRS = f"""FL AS (SELECT DISTINCT {_RUN_FILE} AS path FROM lineitem),
FN AS (SELECT path, {Q.basename('path')} AS name FROM FL),
FE AS (SELECT path, name, {Q.expected_mate('name')} AS expected FROM FN),
R1 AS (SELECT expected, min(path) AS file1 FROM FE WHERE expected IS NOT NULL GROUP BY expected),
R2 AS (SELECT name AS expected, min(path) AS file2 FROM FE WHERE expected IS NULL GROUP BY name),
PR AS (SELECT file1, file2 FROM R1 JOIN R2 ON R1.expected = R2.expected),
USED AS (SELECT file1 AS path FROM PR UNION ALL SELECT file2 FROM PR),
PAIRS AS (SELECT file1, file2 FROM PR
  UNION ALL SELECT path, CAST(NULL AS VARCHAR) FROM FL WHERE path NOT IN (SELECT path FROM USED))"""


@query("detect_pairs", f"WITH {_PAIRS} SELECT file1, file2 FROM PAIRS")
def q_detect_pairs(spark, sf):
    return detect_pairs(_run_files(spark, sf))


_PAIRS_DIR = _PAIRS.replace("GROUP BY expected", "GROUP BY dir, expected").replace("GROUP BY name", "GROUP BY dir, name") \
    .replace("SELECT expected, min(path)", "SELECT dir, expected, min(path)").replace("SELECT name AS expected, min(path)", "SELECT dir, name AS expected, min(path)") \
    .replace("R1.expected = R2.expected", "R1.expected = R2.expected AND R1.dir = R2.dir") \
    .replace("FE AS (SELECT path, name,", "FE AS (SELECT path, name, regexp_extract(path, '^(.*/)', 1) AS dir,")


@query("detect_pairs_same_dir", f"WITH {_PAIRS_DIR} SELECT file1, file2 FROM PAIRS")
def q_detect_pairs_same_dir(spark, sf):
    return detect_pairs(_run_files(spark, sf), same_dir=True)


def _keys(rel: str) -> str:
    return f"(SELECT DISTINCT sample_name AS key FROM {rel} WHERE sample_name IS NOT NULL)"


@query("key_coverage", f"""WITH {CTE}, A AS {_keys('S')}, B AS {_keys('P')}
SELECT coalesce(A.key, B.key) AS key, CASE WHEN A.key IS NULL THEN 'project' ELSE 'sample' END AS only_in
FROM A FULL OUTER JOIN B ON A.key = B.key WHERE A.key IS NULL OR B.key IS NULL""")
def q_key_coverage(spark, sf):
    return R.key_coverage(D.sample_manifest(spark, sf), D.project_manifest(spark, sf), "sample_name")


@query("common_keys", f"WITH {CTE} SELECT key FROM {_keys('S')} INTERSECT SELECT key FROM {_keys('P')}")
def q_common_keys(spark, sf):
    return R.common_keys(D.sample_manifest(spark, sf), D.project_manifest(spark, sf), "sample_name")


@query("keys_except", f"WITH {CTE} SELECT key FROM {_keys('S')} EXCEPT SELECT key FROM {_keys('P')}")
def q_keys_except(spark, sf):
    return R.keys_except(D.sample_manifest(spark, sf), D.project_manifest(spark, sf), "sample_name")


@query("duplicate_keys", f"""WITH {CTE} SELECT sample_name AS key, CAST(count(*) AS BIGINT) AS n_rows,
  min(_row) AS first_row, max(_row) AS last_row FROM S WHERE sample_name IS NOT NULL
GROUP BY sample_name HAVING count(*) > 1""")
def q_duplicate_keys(spark, sf):
    return R.duplicate_keys(D.sample_manifest(spark, sf), "sample_name")


@query("duplicate_rows", f"""WITH {CTE}, C AS (SELECT sample_name, count(*) AS n FROM S WHERE sample_name IS NOT NULL
  GROUP BY sample_name HAVING count(*) > 1)
SELECT S.sample_name AS key, S._row, CAST(C.n AS BIGINT) AS n_rows FROM S JOIN C ON S.sample_name = C.sample_name""")
def q_duplicate_rows(spark, sf):
    return R.duplicate_rows(D.sample_manifest(spark, sf), "sample_name").select("key", "_row", "n_rows")


_S_DATA = [c for c in D.sample_columns("duck") if c != "sample_name"]


@query("missing_cells", f"""WITH {CTE}, M AS (
{' UNION ALL '.join(f"SELECT '{c}' AS col, CAST(count_if({Q.not_blank('sample_name')} AND {Q.blank(c)}) AS BIGINT) AS n_missing FROM S" for c in _S_DATA)})
SELECT col, n_missing FROM M WHERE n_missing > 0""")
def q_missing_cells(spark, sf):
    return R.missing_cells(D.sample_manifest(spark, sf), "sample_name")


@query("tail_data", f"""WITH {CTE}, L AS (SELECT max(CASE WHEN {Q.not_blank('sample_name')} THEN _row END) AS last FROM S),
T AS (SELECT S.* FROM S, L WHERE L.last IS NOT NULL AND S._row > L.last),
C AS ({' UNION ALL '.join(f"SELECT '{c}' AS col, _row FROM T WHERE {Q.not_blank(c)}" for c in _S_DATA)})
SELECT col, CAST(count(*) AS BIGINT) AS n_rows, min(_row) AS first_row, max(_row) AS last_row FROM C GROUP BY col""")
def q_tail_data(spark, sf):
    return R.tail_data(D.sample_manifest(spark, sf), "sample_name")


_S_VOCAB = [f for f in VALID_OPTIONS if f in D.sample_columns("duck")]


@query("change_counts", f"""WITH {CTE}
{' UNION ALL '.join(f"SELECT '{f}' AS col, CAST(count_if({Q.vocab_bad(f, VALID_OPTIONS[f])}) AS BIGINT) AS n_changed FROM S" for f in _S_VOCAB)}""")
def q_change_counts(spark, sf):
    s = D.sample_manifest(spark, sf)
    after = U.enforce_vocab(s, VALID_OPTIONS, DEFAULT_VALUES)
    return R.change_counts(s, after, _S_VOCAB)


@query("count_parity", f"""WITH {CTE} SELECT (SELECT CAST(count(*) AS BIGINT) FROM S) AS n_a,
  (SELECT CAST(count(*) AS BIGINT) FROM P) AS n_b, (SELECT count(*) FROM S) = (SELECT count(*) FROM P) AS equal""")
def q_count_parity(spark, sf):
    return R.count_parity(D.sample_manifest(spark, sf), D.project_manifest(spark, sf))


_COMMON = [c for c in D.sample_columns("duck") if c in D.project_columns("duck")]


@query("common_fields", f"""WITH {CTE}
{' UNION ALL '.join(f"SELECT '{c}' AS col, (SELECT CAST(count(DISTINCT sample_name) AS BIGINT) FROM S) AS n_keys_a, (SELECT CAST(count(DISTINCT sample_name) AS BIGINT) FROM P) AS n_keys_b" for c in _COMMON)}""")
def q_common_fields(spark, sf):
    return R.common_fields(D.sample_manifest(spark, sf), D.project_manifest(spark, sf))


@query("dense_number_text", """SELECT o_orderkey, row_number() OVER (ORDER BY o_clerk_group, o_orderpriority, o_orderkey) AS n
FROM (SELECT o_orderkey, o_orderpriority, CASE WHEN o_custkey % 3 = 0 THEN 'same' WHEN o_custkey % 7 = 1 THEN 'Zü ' || o_orderstatus ELSE o_orderpriority || o_orderstatus END AS o_clerk_group FROM orders)""")
def q_dense_number_text(spark, sf):
    """Numbers in the order of two text columns and a key; a third of all rows tie on the first."""
    o = D.table(spark, sf, "orders").selectExpr("o_orderkey", "o_orderpriority", """CASE WHEN o_custkey % 3 = 0 THEN 'same'
      WHEN o_custkey % 7 = 1 THEN 'Zü ' || o_orderstatus ELSE o_orderpriority || o_orderstatus END AS o_clerk_group""")
    return dense_number(o, ["o_clerk_group", "o_orderpriority", "o_orderkey"], name="n", start=1).select("o_orderkey", "n")


_SIZED = "SELECT o_orderkey, o_orderdate, CAST(o_orderkey * 7919 % 50021 AS BIGINT) AS size FROM orders"


@query("batch_bytes", f"""WITH Z AS (SELECT *, row_number() OVER w AS seq, sum(size) OVER w - size AS before FROM ({_SIZED}) WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING))
SELECT o_orderkey, size, CAST(seq AS BIGINT) AS seq, CAST(before // 300000 + 1 AS BIGINT) AS batch FROM Z""")
def q_batch_bytes(spark, sf):
    """Files in order, in batches of about 300,000 bytes."""
    o = D.table(spark, sf, "orders").selectExpr("o_orderkey", "o_orderdate", "CAST(o_orderkey * 7919 % 50021 AS BIGINT) AS size")
    return assign_batches(o, ["o_orderdate", "o_orderkey"], max_bytes=300_000).select("o_orderkey", "size", "seq", "batch")


@query("batch_bytes_large", f"""WITH Z AS (SELECT *, row_number() OVER w AS seq, sum(size) OVER w - size AS before FROM ({_SIZED}) WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING))
SELECT o_orderkey, CAST(seq AS BIGINT) AS seq, CAST(dense_rank() OVER (ORDER BY before // 20000) AS BIGINT) AS batch FROM Z""")
def q_batch_bytes_large(spark, sf):
    """The same with files that are larger than a batch."""
    o = D.table(spark, sf, "orders").selectExpr("o_orderkey", "o_orderdate", "CAST(o_orderkey * 7919 % 50021 AS BIGINT) AS size")
    return assign_batches(o, ["o_orderdate", "o_orderkey"], max_bytes=20_000).select("o_orderkey", "seq", "batch")


@query("dense_number", """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS n FROM orders""")
def q_dense_number(spark, sf):
    o = D.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return dense_number(o, ["o_orderdate", "o_orderkey"], name="n", start=1).select("o_orderkey", "n")


@query("first_per_key", f"""WITH {CTE} SELECT sample_name, _row, filename, filename2 FROM (
  SELECT *, row_number() OVER (PARTITION BY sample_name ORDER BY _row) AS rn FROM S WHERE sample_name IS NOT NULL)
WHERE rn = 1""")
def q_first_per_key(spark, sf):
    s = D.sample_manifest(spark, sf).select("sample_name", "_row", "filename", "filename2")
    return first_per_key(s, "sample_name").select("sample_name", "_row", "filename", "filename2")


@query("preview", f"""{W} SELECT path, (SELECT CAST(count(*) AS BIGINT) FROM MISS) AS n_total
FROM MISS ORDER BY path LIMIT 10""")
def q_preview(spark, sf):
    return preview(_missing(spark, sf).select("path"), ["path"], 10)


@query("preview_per_group", f"""{W} SELECT key, path, CAST(greatest(n - 5, 0) AS BIGINT) AS n_more FROM (
  SELECT key, path, row_number() OVER (PARTITION BY key ORDER BY path) AS rn,
         count(*) OVER (PARTITION BY key) AS n FROM MISS) WHERE rn <= 5""")
def q_preview_per_group(spark, sf):
    return preview_per_group(_missing(spark, sf).select("key", "path"), "key", ["path"], 5) \
        .select("key", "path", "n_more")


@query("distinct_files", f"""{W} SELECT path, _row AS first_row, CAST(col_pos AS INTEGER) AS first_pos
FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY _row, col_pos) AS rn FROM FR) WHERE rn = 1""")
def q_distinct_files(spark, sf):
    from manifestqc.operators.ledger import distinct_files
    return distinct_files(_refs(spark, sf))
