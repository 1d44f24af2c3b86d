"""Manifest-shaped inputs derived from the driver tables.

The driver tables hold no manifests, so each query derives one from them:
orders become a project table and a sample table (keys, dates in many text
forms, places, coordinates, vocabulary fields, file names), lineitem gives the
inventory of existing files.  Every derived column is written once as SQL
text and rendered for Spark SQL or DuckDB, so both engines see the same input;
the operators under test are then run by the library (Spark) and re-stated
independently in the oracle SQL (DuckDB).

All rows of the tables are used; ``%`` only varies the text shapes.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from manifestqc.operators.rows import dense_number

BASE_DIR = "/data"
TAIL_ROWS = 300


def idiv(a: str, b: str, dialect: str) -> str:
    return f"({a} div {b})" if dialect == "spark" else f"({a} // {b})"


def fmt(ts: str, spark_pat: str, duck_pat: str, dialect: str) -> str:
    if dialect == "spark":
        lit = f'"{spark_pat}"' if "'" in spark_pat else f"'{spark_pat}'"
        return f"date_format({ts}, {lit})"
    return f"strftime({ts}, '{duck_pat}')"


def s(x: str) -> str:
    return f"CAST({x} AS STRING)"


# ----------------------------------------------------------------- columns --
def date_text(dialect: str) -> str:
    """``o_orderdate`` in one of 16 text forms chosen by ``o_orderkey % 16``."""
    d = "o_orderdate"

    def f(sp, dk):
        return fmt(d, sp, dk, dialect)

    return f"""CASE o_orderkey % 16
      WHEN 0 THEN {f('M/d/yyyy', '%-m/%-d/%Y')}
      WHEN 1 THEN {f('d/M/yyyy', '%-d/%-m/%Y')}
      WHEN 2 THEN {f('dd-MMM-yyyy', '%d-%b-%Y')}
      WHEN 3 THEN upper({f('MMM-yyyy', '%b-%Y')})
      WHEN 4 THEN {f('yyyy', '%Y')}
      WHEN 5 THEN {f('yyyy-MM', '%Y-%m')}
      WHEN 6 THEN {f('yyyy/M/d', '%Y/%-m/%-d')}
      WHEN 7 THEN {f('dd-MMM-yyyy', '%d-%b-%Y')} || '/' || {f('yyyy-MM', '%Y-%m')}
      WHEN 8 THEN {f("yyyy-MM-dd'T'HH:mm:ss'Z'", '%Y-%m-%dT%H:%M:%SZ')}
      WHEN 9 THEN ' Not Collected '
      WHEN 10 THEN ''
      WHEN 11 THEN NULL
      WHEN 12 THEN CASE WHEN o_orderkey % 32 = 12 THEN lower({f('dd MMM yyyy', '%d %b %Y')})
                        ELSE 'day ' || {s('o_orderkey')} END
      WHEN 13 THEN '0/45/' || {f('yyyy', '%Y')}
      WHEN 14 THEN 'Oct/' || {f('yyyy', '%Y')}
      ELSE {f('yyyy-M-d', '%Y-%-m-%-d')} END"""


def geo_text(dialect: str) -> str:
    return f"""CASE o_orderkey % 6
      WHEN 0 THEN lower(c_mktsegment)
      WHEN 1 THEN c_mktsegment || ':' || o_orderstatus
      WHEN 2 THEN c_mktsegment || ': x, ' || o_orderpriority
      WHEN 3 THEN NULL
      WHEN 4 THEN '  ' || c_mktsegment || ' '
      ELSE 'NATION ' || c_mktsegment || '1' END"""


def latlon_text(dialect: str) -> str:
    """Coordinates from integer cents of ``c_acctbal`` and ``o_totalprice``
    (exact text, no float printing): decimal pairs, a ready form, integers, null."""
    m = "abs(_ac)"
    lat_abs = f"{s(idiv(m, '100', dialect))} || '.' || lpad({s(f'{m} % 100')}, 2, '0')"
    lat = f"CASE WHEN _ac < 0 THEN '-' ELSE '' END || {lat_abs}"
    lon_abs = f"{s(idiv('_tp', '10000', dialect))} || '.' || lpad({s('_tp % 10000')}, 4, '0')"
    lon = f"CASE WHEN o_orderkey % 2 = 0 THEN '-' ELSE '' END || {lon_abs}"
    return f"""CASE o_orderkey % 5
      WHEN 0 THEN {lat} || ', ' || {lon}
      WHEN 1 THEN {lat} || ' ' || {lon}
      WHEN 2 THEN {lat_abs} || ' N ' || {lon_abs} || ' W'
      WHEN 3 THEN {s(idiv(m, '100', dialect))} || ', ' || {s(idiv('_tp', '10000', dialect))}
      ELSE NULL END"""


def key_text(kind: str) -> str:
    """Sample key: unique per order, with duplicates, blanks, a key-less tail,
    and keys present in one table only."""
    only = "WHEN o_orderkey % 13 = 0 THEN 'P' || " + s("o_orderkey") if kind == "project" \
        else "WHEN o_orderkey % 17 = 0 THEN 'X' || " + s("o_orderkey")
    return f"""CASE WHEN o_orderkey % 211 = 5 THEN NULL
      WHEN o_orderkey % 211 = 6 THEN ''
      WHEN _row >= _n - {TAIL_ROWS} THEN CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE '' END
      {only}
      WHEN o_orderkey % 50 = 49 THEN 'S' || {s('o_orderkey - 1')}
      ELSE 'S' || {s('o_orderkey')} END"""


VOCAB_FIELDS = {
    "library_strategy": """CASE o_orderkey % 9 WHEN 0 THEN 'WGS' WHEN 1 THEN 'AMPLICON' WHEN 2 THEN ''
      WHEN 3 THEN NULL WHEN 4 THEN 'wgs' WHEN 5 THEN 'RNA-Seq' WHEN 6 THEN 'INVALID' WHEN 7 THEN 'WGS '
      ELSE 'OTHER' END""",
    "library_source": "CASE o_orderstatus WHEN 'F' THEN 'METAGENOMIC' WHEN 'O' THEN 'GENOMIC' ELSE '' END",
    "library_selection": """CASE o_orderkey % 4 WHEN 0 THEN 'RANDOM' WHEN 1 THEN 'PCR' WHEN 2 THEN 'random'
      ELSE NULL END""",
    "platform": "CASE o_orderkey % 3 WHEN 0 THEN 'ILLUMINA' WHEN 1 THEN 'illumina' ELSE '' END",
    "instrument_model": """CASE o_orderkey % 5 WHEN 0 THEN 'Illumina MiSeq' WHEN 1 THEN 'NextSeq 500'
      WHEN 2 THEN 'Illumina NovaSeq X' WHEN 3 THEN '' ELSE 'MiSeq' END""",
}


def sample_file1() -> str:
    k = s("o_orderkey")
    return f"CASE WHEN o_orderkey % 10 = 7 THEN '/abs/ord' || {k} || '.fq' ELSE 'ord' || {k} || '_R1.fastq.gz' END"


def sample_file2() -> str:
    k = s("o_orderkey")
    return f"""CASE o_orderkey % 10 WHEN 3 THEN '' WHEN 7 THEN NULL
      WHEN 9 THEN ' ord' || {k} || '_R2.fastq.gz ' ELSE 'ord' || {k} || '_R2.fastq.gz' END"""


def project_columns(dialect: str) -> dict[str, str]:
    k = s("o_orderkey")
    cols = {
        "sample_name": key_text("project"),
        "project_title": "'Order ' || o_orderpriority",
        "sample_source": """CASE o_orderkey % 7 WHEN 0 THEN 'environmental' WHEN 1 THEN 'Environment'
          WHEN 2 THEN ' HOST ' WHEN 3 THEN 'host associated' WHEN 4 THEN 'host-associated' WHEN 5 THEN NULL
          ELSE 'other' END""",
        "collection_date": date_text(dialect),
        "geo_loc_name": geo_text(dialect),
        "lat_lon": latlon_text(dialect),
    }
    cols.update(VOCAB_FIELDS)
    cols["host"] = "CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Homo sapiens' ELSE NULL END"
    cols["filename"] = f"""CASE o_orderkey % 11 WHEN 0 THEN '/other/ord' || {k} || '_R1.fastq.gz'
      WHEN 1 THEN 'zz' || {k} || '.fq' WHEN 2 THEN NULL ELSE {sample_file1()} END"""
    return cols


def sample_columns(dialect: str) -> dict[str, str]:
    k = s("o_orderkey")
    cols = {
        "sample_name": key_text("sample"),
        "library_ID": f"CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'L' || {k} END",
        "title": """'Order ' || o_orderpriority || CASE o_orderkey % 3 WHEN 0 THEN ' Human'
          WHEN 1 THEN ' Mouse Stool' ELSE '' END""",
    }
    cols.update(VOCAB_FIELDS)
    cols["library_layout"] = """CASE o_orderkey % 8 WHEN 0 THEN 'paired' WHEN 1 THEN 'PE'
      WHEN 2 THEN ' Single ' WHEN 3 THEN 'se' WHEN 4 THEN '' WHEN 5 THEN 'pair' WHEN 6 THEN 'single'
      ELSE 'unknown' END"""
    cols["filetype"] = "CASE o_orderkey % 5 WHEN 0 THEN 'bam' WHEN 1 THEN 'FASTQ' ELSE 'fastq' END"
    cols["filename"] = sample_file1()
    cols["filename2"] = sample_file2()
    return cols


def inventory_sql(dialect: str) -> list[str]:
    """Three selects over lineitem whose union is the inventory of paths."""
    k = s("l_orderkey")
    return [
        f"'{BASE_DIR}/ord' || {k} || '_R1.fastq.gz'",
        f"'{BASE_DIR}/ord' || {k} || '_R2.fastq.gz'",
        f"'/abs/ord' || {k} || '.fq'",
    ]


# ------------------------------------------------------------------- Spark --
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def orders_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with ``_row`` (0-based, by o_orderkey) and ``_n`` (row count)
    joined to the customer columns used for places and coordinates."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    numbered = dense_number(o, "o_orderkey", name="_row", start=0)
    n = o.agg(F.count(F.lit(1))).scalar()
    return (numbered.withColumn("_n", n)
            .join(c, numbered.o_custkey == c.c_custkey, "left")
            .withColumn("_ac", F.expr("CAST(round(c_acctbal * 100) AS BIGINT)"))
            .withColumn("_tp", F.expr("CAST(round(o_totalprice * 100) AS BIGINT) % 1800000")))


def project_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders_numbered(spark, sf_dir)
    return base.selectExpr(*[f"{e} AS {n}" for n, e in project_columns("spark").items()], "_row")


def sample_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders_numbered(spark, sf_dir)
    return base.selectExpr(*[f"{e} AS {n}" for n, e in sample_columns("spark").items()], "_row")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    r1, r2, ab = inventory_sql("spark")
    # one scan: each line item yields its R1 path, plus R2 / an absolute path
    # for line numbers 2 / 3 (the same multiset as the union in the oracle)
    paths = (f"array_compact(array({r1}, CASE WHEN l_linenumber = 2 THEN {r2} END, "
             f"CASE WHEN l_linenumber = 3 THEN {ab} END))")
    return li.selectExpr(f"explode({paths}) AS path")


# ------------------------------------------------------------------ DuckDB --
def duck_ctes() -> str:
    """CTEs ``P`` (project), ``S`` (sample), ``I`` (inventory) for oracle SQL."""
    pc = ",\n  ".join(f"{e} AS {n}" for n, e in project_columns("duck").items())
    sc = ",\n  ".join(f"{e} AS {n}" for n, e in sample_columns("duck").items())
    r1, r2, ab = inventory_sql("duck")
    return f"""OB AS (
  SELECT o.*, c.c_mktsegment, c.c_acctbal,
         row_number() OVER (ORDER BY o.o_orderkey) - 1 AS _row,
         count(*) OVER () AS _n,
         CAST(round(c.c_acctbal * 100) AS BIGINT) AS _ac,
         CAST(round(o.o_totalprice * 100) AS BIGINT) % 1800000 AS _tp
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
P AS (SELECT {pc},
  _row FROM OB),
S AS (SELECT {sc},
  _row FROM OB),
I AS (SELECT {r1} AS path FROM lineitem
      UNION ALL SELECT {r2} FROM lineitem WHERE l_linenumber = 2
      UNION ALL SELECT {ab} FROM lineitem WHERE l_linenumber = 3)"""


def orders_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders joined to the customer columns, with the integer-cent helpers
    (no row numbering; for the per-value function queries)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return (o.join(c, o.o_custkey == c.c_custkey, "left")
            .withColumn("_ac", F.expr("CAST(round(c_acctbal * 100) AS BIGINT)"))
            .withColumn("_tp", F.expr("CAST(round(o_totalprice * 100) AS BIGINT) % 1800000")))


DUCK_OC = """OC AS (
  SELECT o.*, c.c_mktsegment, c.c_acctbal,
         CAST(round(c.c_acctbal * 100) AS BIGINT) AS _ac,
         CAST(round(o.o_totalprice * 100) AS BIGINT) % 1800000 AS _tp
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""


def file_shape(dialect: str) -> str:
    """File names in 8 shapes (read-1 patterns, plain, nested folder, null)."""
    k = s("o_orderkey")
    return f"""CASE o_orderkey % 8
      WHEN 0 THEN 'ord' || {k} || '_R1.fastq.gz'
      WHEN 1 THEN 'ord' || {k} || '_1.fq'
      WHEN 2 THEN 'ord' || {k} || '_R1_1.fq'
      WHEN 3 THEN 'ord' || {k} || '.fq'
      WHEN 4 THEN 'ord' || {k} || '_forward.fq'
      WHEN 5 THEN 'run_R1/ord' || {k} || '_f.fq'
      WHEN 6 THEN 'dir_R1/ord' || {k} || '_R1_001.fq'
      ELSE NULL END"""
