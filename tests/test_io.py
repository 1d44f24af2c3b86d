"""Sources and sinks: ragged manifests, round trip, listing, ledger store, streaming."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from manifestqc.operators import ledger as L
from manifestqc.operators.rules import row_width_issues
from manifestqc.sources.config import effective_defaults, load_config, overlay_defaults
from manifestqc.sources.ledger_store import clear_ledger, read_ledger, write_ledger
from manifestqc.sources.manifest import UnsupportedFormat, list_files, read_manifest, write_manifest


def _write(d, name, text):
    p = os.path.join(d, name)
    with open(p, "w") as fh:
        fh.write(text)
    return p


def test_read_ragged_manifest(spark):
    d = tempfile.mkdtemp()
    text = ("sample_name\tfilename\tfilename2\tfilename\n"
            "a\ta_R1.fq\ta_R2.fq\tx\n"
            "b\tb.fq\n"                     # short row
            "c\tc1\tc2\tc3\textra\n"        # wide row: extra cell dropped
            "\t\t\t\n"                      # tabs only: kept as an all-null row
            "\n"                            # empty line: skipped
            "\"USA: Ohio, Cincinnati\"\tq.fq\t\t\n")
    p = _write(d, "m.txt", text)
    df = read_manifest(spark, p)
    assert df.columns == ["sample_name", "filename", "filename2", "filename_1", "_row", "_width"]
    rows = sorted(df.collect(), key=lambda r: r._row)
    assert [r._row for r in rows] == [0, 1, 2, 3, 4]
    assert rows[1].filename2 is None and rows[1]._width == 2
    assert rows[2].filename_1 == "c3" and rows[2]._width == 5
    assert rows[3].sample_name is None and rows[3]._width == 4
    assert rows[4].sample_name == "USA: Ohio, Cincinnati"
    widths = {r.row for r in row_width_issues(df, 4, "sample").collect()}
    assert widths == {1, 2}


def test_reader_refuses_csv_and_na_tokens(spark):
    d = tempfile.mkdtemp()
    with pytest.raises(UnsupportedFormat):
        read_manifest(spark, _write(d, "m.csv", "a,b\n1,2\n"))
    p = _write(d, "n.txt", "k\tv\nNA\tx\nn/a\t\n")
    got = [tuple(r) for r in read_manifest(spark, p, na_tokens="default").select("k", "v").collect()]
    assert sorted(got, key=str) == sorted([(None, "x"), (None, None)], key=str)
    kept = [r.k for r in read_manifest(spark, p).orderBy("_row").collect()]
    assert kept == ["NA", "n/a"]


def test_write_roundtrip_order_and_spaces(spark):
    base = spark.range(0, 3000).select(
        F.col("id").alias("_row"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("sample_name"),
        F.when(F.col("id") % 3 == 0, F.lit(" padded ")).otherwise(F.lit("")).alias("note"))
    out = os.path.join(tempfile.mkdtemp(), "w")
    write_manifest(base.repartition(7), out)
    back = read_manifest(spark, out)
    got = {r._row: (r.sample_name, r.note) for r in back.collect()}
    assert len(got) == 3000
    assert got[0] == ("s0", " padded ") and got[1] == ("s1", None) and got[2997] == ("s2997", " padded ") and got[2999] == ("s2999", None)


def test_written_cells_are_computed_once(spark):
    """Also where the partitions are of different sizes and rows without a number or with equal ones are among them."""
    seen = spark.sparkContext.accumulator(0)

    def cell(n):
        seen.add(1)
        return f"s{n}"

    rows = spark.createDataFrame([(i if i % 10 else i // 100, i) if i % 7 else (None, i) for i in range(2000)], "_row long, n long")
    rows = rows.repartition(F.when(F.col("n") < 1500, 0).otherwise(F.col("n") % 5))
    out = os.path.join(tempfile.mkdtemp(), "once")
    write_manifest(rows.withColumn("cell", F.udf(cell, "string")("n")), out)
    assert seen.value == 2000
    number = {str(i): (i if i % 10 else i // 100) if i % 7 else -1 for i in range(2000)}
    back = [number[r.n] for r in read_manifest(spark, out).orderBy("_row").collect()]
    assert back == sorted(number.values())


def test_list_files(spark):
    d = tempfile.mkdtemp()
    os.makedirs(os.path.join(d, "sub"))
    for n in ("a_R1.fastq.gz", "a_R2.fastq.gz", "b.fq", "c.txt", "sub/d.fastq"):
        _write(d, n, "x")
    got = sorted(r.name for r in list_files(spark, d).collect())
    assert got == ["a_R1.fastq.gz", "a_R2.fastq.gz", "b.fq", "d.fastq"]
    flat = sorted(r.name for r in list_files(spark, d, recursive=False).collect())
    assert "d.fastq" not in flat
    assert all(r.path.startswith("/") for r in list_files(spark, d).collect())


def test_ledger_store_and_accounting(spark):
    loc = os.path.join(tempfile.mkdtemp(), "ledger")
    files = spark.createDataFrame([(f"/f{i}", i, 0) for i in range(7)], "path string, first_row long, first_pos int")
    batches = L.plan_batches(files.withColumn("_o", F.col("first_row")), "_o", 3)
    assert sorted((r.path, r.batch) for r in batches.collect())[:4] == [("/f0", 1), ("/f1", 1), ("/f2", 1), ("/f3", 2)]
    attempts = spark.createDataFrame(
        [(1, 1, None, True), (2, 2, None, False), (3, 2, "/f3", True), (4, 2, "/f4", False), (5, 3, None, False)],
        "attempt_no long, batch long, path string, ok boolean")
    out = L.reduce_attempts(attempts, batches)
    st = {r.path: r.status for r in out.collect()}
    assert st == {"/f0": "uploaded", "/f1": "uploaded", "/f2": "uploaded", "/f3": "uploaded",
                  "/f4": "failed", "/f5": "failed", "/f6": "failed"}
    led = L.merge_ledger(spark.createDataFrame([], "folder string, path string, status string, updated_at timestamp"),
                         out, "run1")
    write_ledger(led, loc)
    back = read_ledger(spark, loc, "run1")
    assert back.count() == 7
    assert sorted(r.path for r in L.pending_files(files, back).collect()) == ["/f4", "/f5", "/f6"]
    s = L.upload_summary(files, back).first()
    assert (s.n_total, s.n_uploaded, s.n_failed, s.all_uploaded) == (7, 4, 3, False)
    retry = spark.createDataFrame([("/f4", "uploaded", 9)], "path string, status string, attempt_no long")
    merged = L.merge_ledger(back, retry, "run1")
    assert {r.path: r.status for r in merged.collect()}["/f4"] == "uploaded"
    clear_ledger(spark, loc, "run1")
    assert read_ledger(spark, loc, "run1").count() == 0
    assert read_ledger(spark, os.path.join(loc, "missing"), "run1").count() == 0


def test_config_overlay(spark, tmp_path):
    p = tmp_path / "c.json"
    p.write_text('{"default_values": {"platform": "X"}, "contact": {"name": "n"}}')
    cfg = load_config(str(p))
    assert effective_defaults(cfg) == {"platform": "X"}
    assert overlay_defaults({"a": "1", "platform": "Y"}, cfg["default_values"]) == {"a": "1", "platform": "X"}
    assert load_config(None) == {} and load_config(str(p), spark)["default_values"] == cfg["default_values"]
    with pytest.raises(FileNotFoundError):
        load_config(str(tmp_path / "none.json"))
    assert effective_defaults(None)["platform"] == "ILLUMINA"


def test_streaming_normalize(spark):
    from manifestqc.streaming.normalize import normalize_stream, read_manifest_stream
    d = tempfile.mkdtemp()
    header = ["sample_name", "collection_date", "geo_loc_name", "lat_lon", "library_layout"]
    _write(d, "a.txt", "\t".join(header) + "\ns1\t7/24/2017\tUSA\t36.9513, -122.0733\tPE\n")
    stream = read_manifest_stream(spark, d, header)
    out = normalize_stream(stream, {"collection_date": "not collected", "library_layout": "paired"})
    q = out.writeStream.format("memory").queryName("norm_test").outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    r = spark.sql("SELECT * FROM norm_test").first()
    assert (r.collection_date, r.geo_loc_name, r.lat_lon, r.library_layout) == \
        ("2017-07-24", "USA:", "36.9513 N 122.0733 W", "paired")


def test_read_numbering_across_splits(spark):
    """Line positions survive a file cut into many input splits."""
    d = tempfile.mkdtemp()
    lines = ["k\tv"] + [f"{i}\t{'x' * (i % 37)}" for i in range(20000)]
    p = _write(d, "big.txt", "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(16 * 1024))
    try:
        df = read_manifest(spark, p)
        assert spark.read.text(p).rdd.getNumPartitions() > 10
        bad = df.filter(F.col("k").cast("long") != F.col("_row")).count()
        assert bad == 0 and df.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_write_list_sorted(spark):
    out = os.path.join(tempfile.mkdtemp(), "list")
    from manifestqc.sources.manifest import write_list
    df = spark.createDataFrame([(p,) for p in ["/b", "/a", "/c", "/a2"]], "path string").repartition(3)
    write_list(df, "path", out)
    parts = sorted(f for f in os.listdir(out) if f.startswith("part-"))
    lines = [line.rstrip("\n") for f in parts for line in open(os.path.join(out, f))]
    assert lines == ["/a", "/a2", "/b", "/c"]


def test_template_shapes(spark):
    """Header-only file, a tail of separator-only rows without any key, CRLF
    line ends and a byte-order mark before the header."""
    from manifestqc.plans.validate import validate_samples
    d = tempfile.mkdtemp()
    empty = read_manifest(spark, _write(d, "h.txt", "sample_name\tfilename\n"))
    assert empty.count() == 0 and empty.columns[:2] == ["sample_name", "filename"]
    tmpl = read_manifest(spark, _write(d, "t.txt", "sample_name\tfilename\n" + "\t\n" * 285))
    assert tmpl.count() == 285
    out, iss = validate_samples(tmpl, {"default_values": {}})
    assert out.count() == 285  # no valid key anywhere: nothing is trimmed
    crlf = read_manifest(spark, _write(d, "c.txt", "\ufeffsample_name\tfilename\r\ns1\ta.fq\r\ns2\tb.fq\r\n"))
    assert crlf.columns[:2] == ["sample_name", "filename"]
    assert sorted((r.sample_name, r.filename) for r in crlf.collect()) == [("s1", "a.fq"), ("s2", "b.fq")]


def test_upload_summary_counts_paths_once_and_only_files(spark):
    files = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "path string")
    ledger = spark.createDataFrame([("f", "a", "uploaded"), ("g", "a", "failed"), ("f", "z", "uploaded"), ("f", "y", "failed"),
                                    ("g", "y", "failed"), ("f", None, "uploaded"), ("f", "b", None)], "folder string, path string, status string")
    got = L.upload_summary(files, ledger)
    assert tuple(got.first()) == (4, 1, 2, False)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 2
    assert tuple(L.upload_summary(files.limit(0), ledger.limit(0)).first()) == (0, 0, 0, True)
    assert tuple(L.upload_summary(files.where("path = 'a'"), ledger.where("folder = 'f' and path = 'a'")).first()) == (1, 1, 0, True)
