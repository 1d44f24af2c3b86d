"""A third of all rows on one key: results stay whole and exact, and the
plans reduce the hot key map-side (partial aggregation / partial window limit)
instead of funnelling it into one task."""

import io
import contextlib

from pyspark.sql import functions as F

from manifestqc.operators import reconcile as R
from manifestqc.operators.pairs import detect_pairs
from manifestqc.operators.rows import first_per_key
from manifestqc.operators.sorts import preview_per_group

N = 30000


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _skewed(spark):
    # rows 0..N-1; every third row carries the hot key "HOT"
    return spark.range(0, N).select(
        F.col("id").alias("_row"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("sample_name"),
        F.concat(F.lit("f"), F.col("id").cast("string"), F.lit("_R1.fq")).alias("filename"),
    ).repartition(8)


def test_hot_key_duplicates_and_first_row(spark):
    df = _skewed(spark)
    d = R.duplicate_keys(df)
    got = d.collect()
    assert [(r.key, r.n_rows, r.first_row, r.last_row) for r in got] == [("HOT", N // 3, 0, N - 3)]
    assert "partial_count" in _plan(d)
    rows = R.duplicate_rows(df)
    assert rows.count() == N // 3
    f = first_per_key(df.select("sample_name", "_row", "filename"), "sample_name")
    hot = f.filter("sample_name = 'HOT'").first()
    assert (hot._row, hot.filename) == (0, "f0_R1.fq") and f.count() == N - N // 3 + 1
    assert "partial_min" in _plan(f)


def test_hot_key_previews_and_missing(spark):
    df = _skewed(spark)
    refs = R.file_refs(df, file_columns=["filename"], base="/d")
    missing = R.missing_files(refs, spark.createDataFrame([("/d/f1_R1.fq",)], "path string"))
    by = R.missing_by_sample(missing).filter("key = 'HOT'").first()
    assert by.n_missing == N // 3
    prev = preview_per_group(missing.select("key", "path"), "key", ["path"], 5)
    hot = prev.filter("key = 'HOT'").collect()
    assert len(hot) == 5 and all(r.n_more == N // 3 - 5 for r in hot)
    plan = _plan(prev)
    assert plan.count("WindowGroupLimit") >= 2  # partial limit runs before the shuffle


def test_hot_name_pairing(spark):
    # a third of the files share one read-1 name across folders
    n = 9000
    files = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("/d"), F.col("id").cast("string"), F.lit("/hot_R1.fq")))
        .when(F.col("id") % 3 == 1, F.concat(F.lit("/e"), F.col("id").cast("string"), F.lit("/s"),
                                             F.col("id").cast("string"), F.lit("_R1.fq")))
        .otherwise(F.concat(F.lit("/e"), (F.col("id") - 1).cast("string"), F.lit("/s"),
                            (F.col("id") - 1).cast("string"), F.lit("_R2.fq"))).alias("path"))
    files = files.unionByName(spark.createDataFrame([("/z/hot_R2.fq",)], "path string"))
    pairs = detect_pairs(files)
    assert pairs.count() == n + 1 - (n // 3 + 1)  # every file once: pairs count once, singles once
    hot = pairs.filter(F.col("file2") == "/z/hot_R2.fq").collect()
    assert [r.file1 for r in hot] == ["/d0/hot_R1.fq"]
    assert pairs.filter("file2 IS NOT NULL").count() == n // 3 + 1
    assert "partial_min" in _plan(pairs)


def test_salted_duplicate_rows_equal(spark):
    df = _skewed(spark)
    plain = sorted(map(tuple, R.duplicate_rows(df).select("key", "_row", "n_rows").collect()))
    salted_df = R.duplicate_rows(df, salt_buckets=8)
    salted = sorted(map(tuple, salted_df.select("key", "_row", "n_rows").collect()))
    assert plain == salted and len(plain) == N // 3
    assert "_salt" in _plan(salted_df)
