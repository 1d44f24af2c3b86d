"""File existence, quoted cells, headers, one-table runs, silent drops, attempts, numbering and splittable joins."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from manifestqc.functions.blank import is_blank_trimmed, strip_ws
from manifestqc.operators import ledger as L
from manifestqc.operators import reconcile as R
from manifestqc.operators.issues import strict_gate
from manifestqc.operators.rows import number_if_absent
from manifestqc.plans.run import validate_files
from manifestqc.plans.upload import plan_upload
from manifestqc.plans.validate import validate_pair
from manifestqc.sources.files import existing_files, qualified
from manifestqc.sources.ledger_store import empty_ledger, read_ledger, write_ledger
from manifestqc.sources.manifest import read_manifest, write_manifest

PROJECT = "sample_name\torganism\tcollection_date\n"
SAMPLE = "sample_name\tlibrary_ID\tfilename\tfilename2\n"


def tables(tmp_path, sample_rows, project_rows):
    p, s = tmp_path / "project.txt", tmp_path / "sample.txt"
    p.write_text(PROJECT + "".join("\t".join(r) + "\n" for r in project_rows))
    s.write_text(SAMPLE + "".join("\t".join(r) + "\n" for r in sample_rows))
    return str(p), str(s)


def test_any_existing_file_is_found(spark, tmp_path):
    data, other = tmp_path / "data" / "fq", tmp_path / "other"
    data.mkdir(parents=True)
    other.mkdir()
    for f in (data / "b.bam", data / "_x.fq", data / ".hidden.fq", other / "c.fq"):
        f.write_text("")
    p, s = tables(tmp_path, [("A", "a", "b.bam", "_x.fq"), ("B", "b", ".hidden.fq", str(other / "c.fq")), ("C", "c", "gone.fq", "")],
                  [("A", "x", "2020-01-01"), ("B", "x", "2020-01-01"), ("C", "x", "2020-01-01")])
    for folder in (str(data), qualified(spark, str(data)), f"file://{data}"):
        _, kept, found, _ = validate_files(spark, p, s, file_dir=folder)
        assert rows(found.where("rule = 'missing_file'"), "key", "value") == [("C", f"{qualified(spark, folder)}/gone.fq")]
    out = str(tmp_path / "out")
    _, kept, found, passed = validate_files(spark, p, s, file_dir=str(data), on_missing="drop", strict=True, output_dir=out)
    assert rows(kept, "sample_name") == [("A",), ("B",)] and passed and os.path.isdir(f"{out}/validated-sample")
    assert rows(found.where("rule = 'removed_sample'"), "key", "severity") == [("C", "info")]
    got = existing_files(spark.createDataFrame([(str(data / "b.bam"),), (f"file://{other}/c.fq",), ("/no/such",), (None,)], "path string"))
    assert rows(got, "path") == [(str(data / "b.bam"),), (f"file://{other}/c.fq",)]


def test_nothing_goes_silently(spark, tmp_path):
    p, s = tables(tmp_path, [("A", "a", "f.fq", "", "extra"), ("", "b", "g.fq", ""), ("C",)], [("A", "x", "2020-01-01"), (" ", "y", ""), ("C", "z", "2020")])
    _, _, found, _ = validate_files(spark, p, s)
    assert rows(found.where("rule = 'row_width'"), "tbl", "row", "value") == [("sample", 0, "5"), ("sample", 2, "1")]
    assert rows(found.where("rule = 'blank_key'"), "tbl", "row") == [("sample", 1)]
    assert rows(found.where("rule = 'file_columns'"), "tbl") == [("project",)]
    bare = spark.createDataFrame([(0, "x")], "_row long, organism string")
    keyed = spark.createDataFrame([(0, "A", "f")], "_row long, sample_name string, filename string")
    _, _, found = validate_pair(bare, keyed)
    assert rows(found.where("rule = 'required_columns'"), "tbl", "col") == [("project", "sample_name")]
    assert not strict_gate(found).first()["passed"]


def test_one_table_and_config_instrument(spark, tmp_path):
    p, s = tables(tmp_path, [("A", "a", "f.fq", ""), ("B", "b", "g.fq", "")], [("A", "x", "2020-01-01")])
    out, none, found, passed = validate_files(spark, p)
    assert none is None and out.count() == 1 and passed
    config = {"default_values": {"instrument_model": "MyBox"}}
    none, out, found, _ = validate_files(spark, None, s, config)
    assert none is None and rows(out, "instrument_model") == [("MyBox",), ("MyBox",)]
    assert found.where("col = 'instrument_model' and rule = 'vocabulary'").count() == 0
    (tmp_path / "empty.txt").write_text(SAMPLE)
    with pytest.raises(ValueError):
        validate_files(spark, None, str(tmp_path / "empty.txt"))


def test_quotes_headers_and_breaks(spark, tmp_path):
    f = tmp_path / "q.txt"
    f.write_text('"sample_name"\t"a ""b"""\tc\n1\t"say ""hi"" now"\t"x\ty"\n2\t"\t\t"\n')
    got = read_manifest(spark, str(f))
    assert got.columns[:3] == ["sample_name", 'a "b"', "c"]
    assert rows(got, *got.columns) == [("1", 'say "hi" now', "x\ty", 0, 3), ("2", "\t\t", None, 1, 2)]
    cells = ['say "hi"', ' "q"', "a\tb", "back\\slash\\n", "line\nbreak\r", "\\", "\\\\n\n", '""']
    df = spark.createDataFrame([(i, str(i), c) for i, c in enumerate(cells)], "_row long, k string, v string")
    out = str(tmp_path / "out")
    with pytest.raises(Exception, match="line break"):
        write_manifest(df, out)
    write_manifest(df, out, breaks="encode")
    back = read_manifest(spark, out, breaks="encode")
    assert [(r.k, r.v) for r in back.orderBy("_row").collect()] == [(str(i), c) for i, c in enumerate(cells)]


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.txt").write_text("sample_name\ttitle\na\tta\n")
    (tmp_path / "d" / "2.txt").write_text("title\tsample_name\ntb\tb\n")
    with pytest.raises(ValueError, match="different headers"):
        read_manifest(spark, str(tmp_path / "d"))


def test_unicode_spaces(spark):
    df = spark.createDataFrame([(" x ",), (" 　\x1c\x85\x0b",), ("a b",)], "c string")
    assert [tuple(r) for r in df.select(strip_ws("c"), is_blank_trimmed("c")).collect()] == [("x", False), ("", True), ("a b", False)]


def test_a_files_own_attempts_come_last(spark):
    batches = spark.createDataFrame([("f1", 1), ("f2", 1), ("f3", 2)], "path string, batch long")
    attempts = spark.createDataFrame([(1, 1, None, False), (2, 1, None, False), (3, 1, None, False), (1, 1, "f1", True), (1, 1, "f2", False), (2, 1, "f2", True), (1, 2, None, True)],
                                     "attempt_no long, batch long, path string, ok boolean")
    assert rows(L.reduce_attempts(attempts, batches)) == [("f1", "uploaded", 1), ("f2", "uploaded", 2), ("f3", "uploaded", 1)]


def test_ledger_spreads_one_folder(spark, tmp_path):
    led = spark.range(2000).selectExpr("'one' AS folder", "'/f' || id AS path", "'uploaded' AS status", "timestamp'2024-01-01' AS updated_at")
    where = str(tmp_path / "ledger")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one task
    write_ledger(led, where)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len([f for f in os.listdir(f"{where}/folder=one") if f.endswith(".parquet")]) > 1
    assert read_ledger(spark, where, "one").count() == 2000 and read_ledger(spark, where + "x", "one").count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_ledger(spark, str(tmp_path / "bad"), "one").count()


def test_plan_upload_orders_by_row_then_position(spark):
    files = spark.createDataFrame([(f"/f{r}_{c}", r, c) for r in range(3) for c in range(70)], "path string, first_row long, first_pos int")
    done = empty_ledger(spark).union(spark.createDataFrame([("s", "/f0_0", "uploaded", None)], empty_ledger(spark).schema))
    got = plan_upload(files, done, 50).orderBy("seq").collect()
    assert [(r.first_row, r.first_pos) for r in got] == [(r, c) for r in range(3) for c in range(70)][1:]
    assert [r.batch for r in got] == [i // 50 + 1 for i in range(209)]


def test_numbers_with_repeated_positions_are_unique(spark):
    df = spark.createDataFrame([(0, "a"), (0, "b"), (2, "c")], "_row long, v string")
    assert sorted(r.n for r in number_if_absent(df, "n", "_row").collect()) == [1, 2, 3]


def test_hot_keys_are_split(spark):
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        df = spark.range(n).select(F.col("id").alias("_row"), F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("sample_name"),
                                   F.when(F.col("id") % 3 == 0, F.lit("/hot.fq")).otherwise(F.concat(F.lit("/f"), F.col("id").cast("string"))).alias("filename")).repartition(16)
        refs = R.file_refs(df, file_columns=["filename"], base="/d")
        inventory = spark.range(40_000).select(F.concat(F.lit("/f"), (F.col("id") * 2).cast("string")).alias("path")).union(spark.createDataFrame([("/hot.fq",)], "path string"))
        bad = spark.range(20_000).select(F.concat(F.lit("k"), (F.col("id") * 7).cast("string")).alias("key")).union(spark.createDataFrame([("none",)], "key string"))
        found = {"missing": R.missing_files(refs, inventory), "verify": R.verify_files(refs, inventory), "remove": R.remove_samples(df, bad),
                 "duplicates": R.duplicate_rows(df), "keep": R.keep_keys(df, R._dealt(bad))}
        for name, out in found.items():
            whole = out.withColumn("part", F.spark_partition_id()).withColumn("h", F.xxhash64(*out.columns))  # keeps all columns in the join
            seen = [r["n"] for r in whole.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.max("h")).collect()]
            most, total = max(seen), sum(seen)
            assert most <= 0.25 * total, (name, most, total)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
