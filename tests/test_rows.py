"""Ranges over composite keys of any type, running sums, byte batches, and the check for gaps and repeats."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from manifestqc.operators import rows as R


def largest_share(df, order, n):
    counts = [r["count"] for r in df.groupBy(R.range_buckets(df, order, n, unique=False).alias("b")).count().collect()]
    return max(counts) / (sum(counts) / n)


def test_ranges_of_text_dates_and_ties_are_even(spark):
    r = random.Random(3)
    rows = [("same" if i % 10 else f"t{r.randrange(100)}", date(2020, 1, 1 + i % 28), i, "x") for i in range(6000)]
    df = spark.createDataFrame(rows, "t string, d date, i long, v string").repartition(5)
    for order in (["t", "i"], "t", "d", ["d", "t"], ["v", "i"], "v"):
        assert largest_share(df, order, 8) <= 2, order


VALUES = {
    "string": ["", "a", "A", "é", "日本", "a b", "aa", None, "\U0001F600", "￿"], "date": [date(1, 1, 1), date(2020, 2, 29), None, date(1969, 12, 31)],
    "timestamp": [datetime(2020, 1, 1, 1, 2, 3, 456789), datetime(1970, 1, 1), None], "timestamp_ntz": [datetime(2020, 1, 1, 1, 2, 3, 456789), datetime(1970, 1, 1), None],
    "double": [0.0, -1.5, float("nan"), float("inf"), float("-inf"), None, 1e300], "decimal(20,3)": [Decimal("1.005"), Decimal("-7"), None], "boolean": [True, False, None],
    "binary": [b"", b"\x00", b"\xff", b"\x7f", None], "array<int>": [[], [1], [1, 2], [0, 9], None, [None]], "struct<a:int,b:string>": [(1, "x"), (1, "a"), (0, "z"), None],
}


@pytest.mark.parametrize("kind", list(VALUES))
def test_ranges_follow_the_sort_order_of_every_type(spark, kind):
    r = random.Random(7)
    df = spark.createDataFrame([(r.choice(VALUES[kind]), i) for i in range(300)], f"k {kind}, i long").repartition(4)
    got = R.dense_number(df, ["k", "i"], name="n", n_buckets=6).orderBy("n").select("i", "n").collect()
    assert [x.i for x in got] == [x.i for x in df.orderBy("k", "i").collect()] and [x.n for x in got] == list(range(300))


def test_rows_that_tie_on_everything_but_are_not_equal(spark):
    df = spark.createDataFrame([("k", i) for i in range(500)] + [("k", 7)] * 20, "k string, i long")
    assert sorted(x.n for x in R.dense_number(df, "k", name="n", start=1, n_buckets=5, unique=False).collect()) == list(range(1, 521))


@pytest.mark.parametrize("values,ok", [
    (range(10), True), ([], True), ([5], True), ([0, 0], False), ([0, 2], False), ([0, 1, 1, 3], False), ([0, 1, 2, 3, 2, 3, 6, 7], False), ([0, 1, 2, 3, 2, 3], False),
    ([3, 4, 5, 0, 1, 2], True), ([None, 1, 2], False), ([0, 0, 2], False)])
@pytest.mark.parametrize("parts", [1, 3])
def test_gaps_and_repeats(spark, values, ok, parts):
    df = spark.createDataFrame([(v,) for v in values], "_row long").coalesce(1) if parts == 1 else spark.sparkContext.parallelize([(v,) for v in values], 3).toDF("_row long")
    assert spark.range(1).select(R.gap_free(df, "_row").alias("ok")).first().ok is ok
    if None not in values:
        got = sorted((r._row, r.n) for r in R.number_and_trim(df, None, "n", "_row", start=1).collect())
        assert [n for _, n in got] == list(range(1, len(values) + 1))


def test_no_job_runs_while_the_frame_is_built(spark):
    df = spark.range(1000).withColumnRenamed("id", "_row").withColumn("sample_name", F.lit("s"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "frame")
    out = R.number_and_trim(df, "sample_name", "file_number")
    assert not tracker.getJobIdsForGroup("lazy")
    assert out.where("file_number <> _row + 1").isEmpty()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("limit", [1, 100, 137, 5000, 10**9])
def test_byte_batches(spark, limit):
    r = random.Random(11)
    rows = [(f"k{i:04d}", r.choice([0, 1, 50, 99, 300, None])) for i in range(400)]
    df = spark.createDataFrame(rows, "path string, size long").repartition(4)
    got = sorted(tuple(x) for x in R.assign_batches(df, "path", max_bytes=limit).select("seq", "path", "size", "batch").collect())
    before, slots = 0, []
    for _, size in rows:
        slots.append(before // limit)
        before += size or 0
    number = {s: i + 1 for i, s in enumerate(sorted(set(slots)))}
    assert [(g[0], g[1], g[3]) for g in got] == [(i + 1, rows[i][0], number[s]) for i, s in enumerate(slots)]
    with pytest.raises(ValueError):
        R.assign_batches(df, "path")
    with pytest.raises(Exception, match="negative"):
        R.assign_batches(df.withColumn("size", F.lit(-1)), "path", max_bytes=5).collect()


def test_each_range_is_a_task_of_its_own(spark):
    """Hashed range ids left some tasks empty and gave others several ranges."""
    df = spark.range(8000).select((F.col("id") * 7919 % 8000).alias("k"))
    sizes = [r["count"] for r in R.dense_number(df, "k").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2000
