"""Scalar Column functions against the case tables of the fixtures (F3, F4, F5, F7)."""

import pytest
from pyspark.sql import functions as F

from manifestqc.functions import (
    basename, canonicalize, destination_path, expected_mate, infer_host, infer_isolation_source,
    infer_sample_source, is_blank, is_blank_trimmed, is_sequence_file, mate_name, normalize_date,
    normalize_date_strict, normalize_geo, normalize_latlon, resolve_path, safe_name,
    sample_name_from_file, transfer_ok, apply_na_tokens, LAYOUT_SYNONYMS, SOURCE_SYNONYMS,
)

DATE_CASES = [
    ("2023-07-15", "2023-07-15"), ("07/15/2023", "2023-07-15"), ("15/07/2023", "2023-07-15"),
    ("15-Jul-2023", "2023-07-15"), ("Jul-2023", "2023-07"), ("2023", "2023"),
    ("2023-07-15T12:00:00Z", "2023-07-15T12:00:00Z"), ("15-Jul-2023/20-Jul-2023", "2023-07-15/2023-07-20"),
    ("invalid", "invalid"), ("7/24/2017", "2017-07-24"), ("24/7/2017", "2017-07-24"),
    ("2017-07-24", "2017-07-24"), ("2017-07", "2017-07"), ("2017", "2017"), ("24-Jul-2017", "2017-07-24"),
    ("Jul-2017", "2017-07"), ("2017/07/24", "2017-07-24"), ("not collected", "not collected"),
    ("unknown", "unknown"), ("12/1/2016", "2016-12-01"), ("1/12/2016", "2016-01-12"),
    ("13/12/2016", "2016-12-13"), ("", ""), (None, ""), (" Not Collected ", "Not Collected"),
    ("25/13/2016", "2016-01-25"), ("0/45/2017", "2017-01-01"), ("12-Foo-2020", "12-Foo-2020"),
    ("99-Jul-2017", "2017-07-99"), ("2017-7-4", "2017-07-04"), ("Oct/1990", "Oct/1990"),
    ("24/Jul/2017", "2017-07-24"), ("24 Jul 2017", "2017-07-24"), ("2017/", "2017/"),
    ("2020/2021", "2020/2021"), ("2023-13-45", "2023-13-45"),
    ("7/24/2017/7/25/2017", "7/24/2017/7/25/2017"), ("JUL-2023", "2023-07"), ("  ", ""),
]
STRICT_DIFF = {"invalid": "not collected", "": "not collected", None: "not collected",
               "  ": "not collected", "2017/": "2017/not collected", "Oct/1990": "not collected/1990",
               "12-Foo-2020": "not collected", "7/24/2017/7/25/2017": "not collected",
               "2020/2021": "2020/2021"}


def _eval(spark, cases, fn):
    df = spark.createDataFrame([(a,) for a in cases], "i string")
    return {r.i: r.o for r in df.select("i", fn(F.col("i")).alias("o")).collect()}


def test_dates_lenient(spark):
    got = _eval(spark, [a for a, _ in DATE_CASES], normalize_date)
    for a, e in DATE_CASES:
        assert got[a] == e, (a, got[a], e)


def test_dates_strict(spark):
    got = _eval(spark, [a for a, _ in DATE_CASES], normalize_date_strict)
    for a, e in DATE_CASES:
        want = STRICT_DIFF.get(a, e)
        assert got[a] == want, (a, got[a], want)


def test_dates_idempotent(spark):
    once = _eval(spark, [a for a, _ in DATE_CASES], normalize_date)
    twice = _eval(spark, list(set(once.values())), normalize_date)
    for v in once.values():
        assert twice[v] == v


GEO = [("USA:California", "USA:California"), ("USA", "USA:"),
       ("USA:California:San Francisco", "USA:California:San Francisco"),
       ("Invalid Format", "Invalid Format:"), ("USA: Ohio, Cincinnati", "USA: Ohio, Cincinnati"),
       (None, ""), ("  ", ""), (" Canada ", "Canada:")]
LATLON = [("36.9513 N 122.0733 W", "36.9513 N 122.0733 W"), ("36.9513, -122.0733", "36.9513 N 122.0733 W"),
          ("-36.9513, 122.0733", "36.9513 S 122.0733 E"), ("Invalid Format", "Invalid Format"),
          ("48.40, 9.98", "48.4 N 9.98 E"), ("-0.0005 0.5", "0.0005 S 0.5 E"), ("45, -75", "45, -75"),
          ("-0.0, 1.000", "0.0 N 1.0 E"), ("007.50,-000.10", "7.5 N 0.1 W"), (None, "")]


@pytest.mark.parametrize("fn,cases", [(normalize_geo, GEO), (normalize_latlon, LATLON)])
def test_geo_latlon(spark, fn, cases):
    got = _eval(spark, [a for a, _ in cases], fn)
    for a, e in cases:
        assert got[a] == e, (a, got[a], e)
    again = _eval(spark, [e for _, e in cases], fn)
    for _, e in cases:
        assert again[e] == e


def test_file_names(spark):
    files = ["a_R1.fastq.gz", "b_1.fq", "c_forward.fq", "d_f.fq", "e_R1_001.fastq.gz", "g.fastq",
             "h_R2.fastq", "s_R1_001.fq", "x_R1_1.fq", "x.fq"]
    df = spark.createDataFrame([(f,) for f in files], "f string").select(
        "f", expected_mate("f").alias("m"), sample_name_from_file("f").alias("s"),
        mate_name("f").alias("mn"))
    got = {r.f: (r.m, r.s, r.mn) for r in df.collect()}
    assert got["a_R1.fastq.gz"] == ("a_R2.fastq.gz", "a", "a_R2.fastq.gz")
    assert got["b_1.fq"] == ("b_2.fq", "b", "b_2.fq")
    assert got["c_forward.fq"][0:2] == ("c_reverse.fq", "c_forward.fq")
    assert got["d_f.fq"][0:2] == ("d_r.fq", "d_f.fq")
    assert got["e_R1_001.fastq.gz"][0:2] == ("e_R2_001.fastq.gz", "e_R1_001.fastq.gz")
    assert got["g.fastq"][0] is None and got["h_R2.fastq"] == (None, "h", "")
    assert got["s_R1_001.fq"][0] == "s_R2_001.fq"
    assert got["x_R1_1.fq"][2] == "x_R2_2.fq" and got["x.fq"][2] == ""


def test_paths_and_names(spark):
    df = spark.createDataFrame([("a/b/c.fq", "/d"), ("/abs/x.fq", "/d"), (" y.fq ", "/d/"), ("z.fq", "")],
                               "p string, b string")
    out = df.select(basename("p").alias("bn"), resolve_path(F.col("p"), F.col("b")).alias("rp"),
                    is_sequence_file(F.trim("p")).alias("q")).collect()
    assert [r.bn for r in out] == ["c.fq", "x.fq", " y.fq ", "z.fq"]
    assert [r.rp for r in out] == ["/d/a/b/c.fq", "/abs/x.fq", "/d/y.fq", "z.fq"]
    assert all(r.q for r in out)
    d2 = spark.createDataFrame([("my run#1", "dest//"), ("", "x"), (None, "y/")], "n string, d string")
    o2 = d2.select(safe_name("n").alias("s")).withColumn("dp", destination_path(F.lit("dest//"), F.col("s"))).collect()
    assert [r.s for r in o2] == ["my_run_1", "sra_submission", "sra_submission"]
    assert o2[0].dp == "dest/my_run_1"


def test_synonyms_keywords(spark):
    df = spark.createDataFrame([(" PE ",), ("Se",), ("paired",), ("invalid",), (None,)], "v string")
    got = [r.o for r in df.select(canonicalize("v", LAYOUT_SYNONYMS).alias("o")).collect()]
    assert got == ["paired", "single", "paired", "invalid", None]
    df = spark.createDataFrame([("Host Associated",), ("ENVIRONMENT",)], "v string")
    assert [r.o for r in df.select(canonicalize("v", SOURCE_SYNONYMS).alias("o")).collect()] == \
        ["host-associated", "environmental"]
    t = spark.createDataFrame([("Human Mouse Stool",), ("Mouse gut",), ("soil",), (None,)], "t string")
    o = t.select(infer_sample_source("t").alias("s"), infer_host("t").alias("h"),
                 infer_isolation_source("t").alias("i")).collect()
    assert [tuple(r) for r in o] == [("host-associated", "Homo sapiens", "Stool"),
                                     ("host-associated", "Mus musculus", ""),
                                     ("environmental", "", ""), ("environmental", "", "")]


def test_transfer_outcome(spark):
    cases = [(0, "done", True), (1, "anything", False), (0, "Session Stop (Error)", False),
             (0, "2 files failed", False), (0, "1 File Failed", False), (0, "0 files failed", True),
             (0, "0 files failed ... 2 files failed", True)]
    df = spark.createDataFrame([(c, o) for c, o, _ in cases], "c int, o string")
    got = [r.ok for r in df.select(transfer_ok("c", "o").alias("ok")).collect()]
    assert got == [e for _, _, e in cases]


def test_blank_and_na(spark):
    df = spark.createDataFrame([(None,), ("",), (" \t",), ("NA",), ("x",)], "v string")
    o = df.select(is_blank("v").alias("b"), is_blank_trimmed("v").alias("t"),
                  apply_na_tokens(F.col("v"), ("NA",)).alias("n")).collect()
    assert [r.b for r in o] == [True, True, False, False, False]
    assert [r.t for r in o] == [True, True, True, False, False]
    assert [r.n for r in o] == [None, "", " \t", None, "x"]


def test_a_cell_is_trimmed_once(spark):
    from manifestqc.operators import rules as U
    df = spark.createDataFrame([("\u00a02017-7-4\t", " 1.50, -2.0\n", "\u2028usa "), ("a  b\n", "\x85", None), (None, "x y", ""), ("\n", None, "\U0001f600 ")],
                               "collection_date string, lat_lon string, geo_loc_name string")
    out = U.date_column(U.latlon_column(U.geo_column(df)))
    assert out.columns == df.columns
    assert [tuple(r) for r in out.collect()] == [("2017-07-04", "1.5 N 2.0 W", "usa:"), ("a  b", "", ""), (None, "x y", ""), ("\n", "", "\U0001f600")]
    plan = U.date_column(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") <= 3  # the cell's own, and that of the halves of a range
