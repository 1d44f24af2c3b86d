"""Driver queries for sources and sinks: manifest read / write round trip,
ragged rows, row widths, file listing and the ledger store.  Files are
written under the session's shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from driverq import derive as D
from driverq.catalog_ops import FOLDER, WP, _ledger
from driverq.registry import query
from manifestqc.operators import rules as U
from manifestqc.session import scratch_path
from manifestqc.sources.files import existing_files, file_system, qualified
from manifestqc.sources.ledger_store import read_ledger, write_ledger
from manifestqc.sources.manifest import list_files, read_manifest, write_manifest

CTE = D.duck_ctes()
_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


@query("read_manifest", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  o_orderstatus, o_orderpriority, row_number() OVER (ORDER BY o_orderkey) - 1 AS _row, CAST(4 AS BIGINT) AS _width
FROM orders""")
def q_read_manifest(spark, sf):
    out = scratch_path(spark, "orders-manifest")
    o = D.table(spark, sf, "orders").select(*[F.col(c).cast("string") if c in ("o_orderkey", "o_custkey") else F.col(c)
                                              for c in _ORDER_COLS], F.col("o_orderkey").alias("_ord"))
    write_manifest(o, out, order_col="_ord", drop=("_ord",))
    return read_manifest(spark, out)


_S_COLS = list(D.sample_columns("duck"))


# quotes, doubled quotes, separators, backslashes and line breaks in one column
_HARD = """CASE _row % 6 WHEN 0 THEN '"q" ' || {t} WHEN 1 THEN {t} || chr(9) || 'tab' WHEN 2 THEN 'back\\slash\\n ' || {t}
  WHEN 3 THEN 'line' || chr(10) || 'break' || chr(13) || {t} WHEN 4 THEN ' say ""hi"" \\' ELSE {t} END"""
_HARD_SPARK = _HARD.replace("\\", "\\\\")


def _hard_cell(c):
    return _HARD.format(t="title") + " AS title" if c == "title" else f"nullif({c}, '') AS {c}"


@query("write_roundtrip", f"""WITH {CTE} SELECT {', '.join(map(_hard_cell, _S_COLS))}, _row,
  CAST({len(_S_COLS)} AS BIGINT) AS _width FROM S""")
def q_write_roundtrip(spark, sf):
    out = scratch_path(spark, "sample-manifest")
    hard = D.sample_manifest(spark, sf).withColumn("title", F.expr(_HARD_SPARK.format(t="title")))
    write_manifest(hard, out, breaks="encode")
    return read_manifest(spark, out, breaks="encode")


@query("read_quoted", f"""WITH {CTE} SELECT {', '.join(map(_hard_cell, _S_COLS))}, _row,
  CAST({len(_S_COLS)} AS BIGINT) AS _width FROM S""")
def q_read_quoted(spark, sf):
    """The same cells as they are: quoted cells over separators and lines."""
    out = scratch_path(spark, "quoted-manifest")
    hard = D.sample_manifest(spark, sf).withColumn("title", F.expr(_HARD_SPARK.format(t="title")))
    write_manifest(hard, out, breaks="quote")
    return read_manifest(spark, out)


# by key: an unclosed quote, one that a later line seems to close, a quoted cell over two lines, plain text, a quote inside text
_QUOTED_LINE = """CASE o_orderkey % 8 WHEN 0 THEN {k} || chr(9) || '"5 inch' || chr(9) || o_orderstatus
  WHEN 1 THEN {k} || chr(9) || '"x' || chr(9) || 'y" z' WHEN 2 THEN {k} || chr(9) || '"over' || chr(10) || 'lines"' || chr(9) || o_orderstatus
  WHEN 3 THEN {k} || chr(9) || '5" ' || o_orderpriority || chr(9) || '""' ELSE {k} || chr(9) || o_orderpriority || chr(9) || o_orderstatus END"""
_K = "CAST(o_orderkey AS STRING)"


@query("open_quotes", """WITH O AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS _row, o_orderkey % 8 AS m, o_orderpriority AS p, o_orderstatus AS s FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE m WHEN 0 THEN '"5 inch' WHEN 1 THEN '"x' WHEN 2 THEN 'over' || chr(10) || 'lines' WHEN 3 THEN '5" ' || p ELSE p END AS title,
  CASE m WHEN 1 THEN 'y" z' WHEN 3 THEN NULL ELSE s END AS status, _row, m IN (0, 1) AS open_quote FROM O""")
def q_open_quotes(spark, sf):
    """Lines with open quotes beside quoted cells over two lines: cells, rows and the rows of the ``open_quote`` issue."""
    out = scratch_path(spark, "open-quotes")
    o = D.table(spark, sf, "orders").select("o_orderkey", F.expr(_QUOTED_LINE.format(k=_K)).alias("value"))
    o.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").select("value").write.text(out)
    rows = read_manifest(spark, out, header=["o_orderkey", "title", "status"], check=False, open_quotes=True)
    marked = U.open_quote_issues(rows, "orders", "o_orderkey").select(F.col("row").alias("_row"), F.lit(True).alias("_issue"))
    return rows.join(marked, "_row", "left").select("o_orderkey", "title", "status", "_row", F.coalesce("_issue", F.lit(False)).alias("open_quote"))


_RAGGED_HEADER = ["o_orderkey", "o_orderpriority", "o_orderstatus", "o_orderdate"]
_DAY = "date_format(o_orderdate, 'yyyy-MM-dd')"


def _ragged(spark, sf):
    """Tab-separated lines with 4, 2, 6 or 4 empty cells (by key), written in key order."""
    out = scratch_path(spark, "ragged")
    o = D.table(spark, sf, "orders")
    k = F.col("o_orderkey").cast("string")
    full = [k, F.col("o_orderpriority"), F.col("o_orderstatus"), F.expr(_DAY)]
    line = (F.when(F.col("o_orderkey") % 4 == 0, F.concat_ws("\t", *full))
            .when(F.col("o_orderkey") % 4 == 1, F.concat_ws("\t", *full[:2]))
            .when(F.col("o_orderkey") % 4 == 2, F.concat_ws("\t", *full, F.lit("x1"), F.lit("x2")))
            .otherwise(F.lit("\t\t\t")))
    (o.select("o_orderkey", line.alias("value")).repartitionByRange("o_orderkey")
      .sortWithinPartitions("o_orderkey").select("value").write.mode("overwrite").text(out))
    return out


def _ragged_read(spark, sf):
    return read_manifest(spark, _ragged(spark, sf), header=_RAGGED_HEADER, check=False)


@query("pad_rows", """SELECT CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS o_orderkey,
  CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderkey % 4 IN (0, 2) THEN o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 4 IN (0, 2) THEN strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate,
  row_number() OVER (ORDER BY o_orderkey) - 1 AS _row,
  CAST(CASE o_orderkey % 4 WHEN 1 THEN 2 WHEN 2 THEN 6 ELSE 4 END AS BIGINT) AS _width FROM orders""")
def q_pad_rows(spark, sf):
    return _ragged_read(spark, sf)


@query("row_width", """SELECT row, value FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row,
  CAST(CASE o_orderkey % 4 WHEN 1 THEN 2 WHEN 2 THEN 6 ELSE 4 END AS VARCHAR) AS value, o_orderkey FROM orders)
WHERE o_orderkey % 4 IN (1, 2)""")
def q_row_width(spark, sf):
    return U.row_width_issues(_ragged_read(spark, sf), len(_RAGGED_HEADER), "orders", key="o_orderkey") \
        .select("row", "value")


_FILE_NAME = """'sup' || CAST(s_suppkey AS STRING) || CASE s_suppkey % 6 WHEN 0 THEN '_R1.fastq.gz' WHEN 1 THEN '_2.fq'
  WHEN 2 THEN '.fastq' WHEN 3 THEN '.bam' WHEN 4 THEN '.FQ' ELSE '_1.fq.gz' END"""


def _touch(spark, sf, name, names=_FILE_NAME):
    """A folder with one small file per supplier, some of them sequence files by name."""
    out = qualified(spark, scratch_path(spark, name))

    def touch(frames):
        where, root = file_system(out)
        for pdf in frames:
            for n in pdf["name"]:
                where.create_dir(f"{root}/{n}".rpartition("/")[0], recursive=True)
                with where.open_output_stream(f"{root}/{n}", compression=None) as f:
                    f.write(b"@" * (len(n) % 5))
            yield pdf

    D.table(spark, sf, "supplier").selectExpr(f"{names} AS name").mapInPandas(touch, "name string").write.format("noop").mode("overwrite").save()
    return out


@query("list_files", f"SELECT name FROM (SELECT {_FILE_NAME} AS name FROM supplier) WHERE regexp_matches(name, '\\.(fastq|fq)(\\.gz)?$')")
def q_list_files(spark, sf):
    return list_files(spark, _touch(spark, sf, "listing")).select("name")


# folders by nation and key, some hidden, and names that start with _ or .
_NESTED = f"""'n' || CAST(s_nationkey AS STRING) || CASE s_suppkey % 3 WHEN 0 THEN '/.hidden/' WHEN 1 THEN '/_d' || CAST(s_suppkey % 7 AS STRING) || '/deep/' ELSE '/' END
  || CASE s_suppkey % 4 WHEN 0 THEN '_' WHEN 1 THEN '.' ELSE '' END || {_FILE_NAME}"""


@query("list_files_nested", f"""SELECT path, regexp_extract(path, '[^/]*$') AS name, CAST(length(path) % 5 AS BIGINT) AS length FROM (SELECT {_NESTED} AS path FROM supplier)
WHERE regexp_matches(path, '\\.(fastq|fq)(\\.gz)?$')""")
def q_list_files_nested(spark, sf):
    """Folders in folders, hidden ones too, listed level by level."""
    out = _touch(spark, sf, "nested", _NESTED)
    return list_files(spark, out).select(F.expr(f"substring(path, {len(out) + 2})").alias("path"), "name", "length")


@query("existing_files", f"""SELECT {_FILE_NAME} AS name FROM supplier""")
def q_existing_files(spark, sf):
    """Probes of the file names of all suppliers, and of as many that are not there."""
    out = _touch(spark, sf, "probes")
    names = D.table(spark, sf, "supplier").selectExpr(f"concat('{out}/', {_FILE_NAME}) AS path")
    probes = names.union(names.selectExpr("concat(path, '.absent')")).union(names)
    return existing_files(probes).selectExpr("substring_index(path, '/', -1) AS name")


@query("ledger_read", f"{WP} SELECT '{FOLDER}' AS folder, path, status FROM OUTC")
def q_ledger_read(spark, sf):
    loc = scratch_path(spark, "ledger")
    write_ledger(_ledger(spark, sf), loc)
    return read_ledger(spark, loc, FOLDER).select("folder", "path", "status")


@query("ledger_write", f"""{WP}, L AS (SELECT '{FOLDER}' AS folder, status FROM OUTC
  UNION ALL SELECT 'retry', status FROM OUTC WHERE status = 'failed')
SELECT folder, status, CAST(count(*) AS BIGINT) AS n FROM L GROUP BY folder, status""")
def q_ledger_write(spark, sf):
    loc = scratch_path(spark, "ledger")
    led = _ledger(spark, sf)
    write_ledger(led, loc)
    write_ledger(led.filter("status = 'failed'").withColumn("folder", F.lit("retry")), loc)
    back = spark.read.parquet(loc)
    return back.groupBy("folder", "status").agg(F.count(F.lit(1)).cast("long").alias("n"))



def _pair_sql() -> str:
    from driverq.registry import ORACLES
    return ORACLES["validate_pair"]


def _one_sql() -> str:
    """The sample table alone, samples with a missing file removed."""
    from driverq.catalog_ops import one_table_sql
    return one_table_sql()


@query("one_table", _one_sql())
def q_one_table(spark, sf):
    """The one-table file flow: written, read back, validated, samples with missing files dropped, gated."""
    from driverq.catalog_rel import BASE
    from manifestqc.plans.run import validate_files
    s_dir = scratch_path(spark, "sample-alone")
    write_manifest(D.sample_manifest(spark, sf), s_dir)
    _, _, found, _ = validate_files(spark, None, s_dir, None, inventory=D.inventory(spark, sf), base=BASE, on_missing="drop")
    return found.groupBy("rule", "tbl", "severity").agg(F.count(F.lit(1)).cast("long").alias("n_issues"))


@query("one_table_keyless", f"""WITH {CTE} SELECT 'required_columns' AS rule, 'sample' AS tbl, 'sample_name' AS col, CAST(NULL AS BIGINT) AS "row", 'error' AS severity
  FROM S HAVING count(*) > 0
UNION ALL SELECT 'row_width', 'sample', NULL, _row, 'warning' FROM S WHERE _row % 50 = 0""")
def q_one_table_keyless(spark, sf):
    """A table without its key column, and with some lines too wide."""
    from manifestqc.plans.validate import validate_table
    keyless = D.sample_manifest(spark, sf).drop("sample_name")
    wide = keyless.withColumn("_width", F.when(F.col("_row") % 50 == 0, 99).otherwise(len(_S_COLS) - 1).cast("long"))
    _, found = validate_table(wide, tbl="sample")
    return found.where("rule in ('required_columns', 'row_width')").select("rule", "tbl", "col", "row", "severity")


@query("validate_files", _pair_sql())
def q_validate_files(spark, sf):
    """The file flow end to end: both derived tables are written as manifests,
    read back, validated, reconciled with the inventory, gated and written."""
    from manifestqc.plans.run import validate_files
    from driverq.catalog_rel import BASE
    p_dir = scratch_path(spark, "project-in")
    s_dir = scratch_path(spark, "sample-in")
    write_manifest(D.project_manifest(spark, sf), p_dir)
    write_manifest(D.sample_manifest(spark, sf), s_dir)
    inv = D.inventory(spark, sf)
    _, _, found, _ = validate_files(spark, p_dir, s_dir, None, output_dir=scratch_path(spark, "validated"),
                                    inventory=inv, base=BASE)
    return found.groupBy("rule", "tbl", "severity").agg(F.count(F.lit(1)).cast("long").alias("n_issues"))
