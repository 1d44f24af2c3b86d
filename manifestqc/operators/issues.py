"""One long issues table for every rule.

Schema ``(rule, tbl, col, key, row, value, message, severity)``; severities
``error`` > ``warning`` > ``info``.  Rules emit rows lazily and are combined
with ``unionByName``; summaries are aggregates over that union.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISSUE_SCHEMA = T.StructType([
    T.StructField("rule", T.StringType(), False),
    T.StructField("tbl", T.StringType(), True),
    T.StructField("col", T.StringType(), True),
    T.StructField("key", T.StringType(), True),
    T.StructField("row", T.LongType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("message", T.StringType(), True),
    T.StructField("severity", T.StringType(), False),
])
ISSUE_COLUMNS = [f.name for f in ISSUE_SCHEMA.fields]
SEVERITY_RANK = {"info": 0, "warning": 1, "error": 2}
# Rules that fail a strict run.
STRICT_RULES = ("duplicate_keys", "blank_date", "key_coverage", "filename_mismatch",
                "missing_file", "required_columns")


def _lit_or_col(v, dtype: str = "string") -> Column:
    if isinstance(v, Column):
        return v.cast(dtype)
    return F.lit(v).cast(dtype)


def issues(df: DataFrame, cond: Column | None, rule: str, tbl: str | None,
           col=None, key=None, row=None, value=None, message=None,
           severity: str = "warning") -> DataFrame:
    """Issue rows for the rows of ``df`` where ``cond`` holds.  Column
    arguments may be Columns (per row) or plain values (constant)."""
    src = df if cond is None else df.filter(cond)
    return src.select(
        F.lit(rule).alias("rule"),
        _lit_or_col(tbl).alias("tbl"),
        _lit_or_col(col).alias("col"),
        _lit_or_col(key).alias("key"),
        _lit_or_col(row, "long").alias("row"),
        _lit_or_col(value).alias("value"),
        _lit_or_col(message).alias("message"),
        F.lit(severity).alias("severity"),
    )


def empty_issues(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ISSUE_SCHEMA)


def driver_issues(spark: SparkSession, rows: Iterable[Sequence]) -> DataFrame:
    """Issues found from metadata alone (column lists, config), no job needed."""
    return spark.createDataFrame(list(rows), ISSUE_SCHEMA)


def union_issues(parts: Sequence[DataFrame]) -> DataFrame:
    parts = [p.select(*ISSUE_COLUMNS) for p in parts]
    return reduce(lambda a, b: a.unionByName(b), parts)


def issue_summary(issue_df: DataFrame) -> DataFrame:
    """``(rule, severity, n_issues)``."""
    return issue_df.groupBy("rule", "severity").agg(F.count(F.lit(1)).cast("long").alias("n_issues"))


def severity_rank(c: Column) -> Column:
    out = None
    for name, rank in SEVERITY_RANK.items():
        out = F.when(c == name, F.lit(rank)) if out is None else out.when(c == name, F.lit(rank))
    return out.otherwise(F.lit(0))


def strict_gate(issue_df: DataFrame, rules: Sequence[str] = STRICT_RULES) -> DataFrame:
    """One row ``(n_blocking, passed)``: a strict run fails when any issue of
    the listed rules (or any ``error``) is present."""
    blocking = F.col("rule").isin(*rules) | (F.col("severity") == "error")
    return issue_df.agg(
        F.count_if(blocking).cast("long").alias("n_blocking"),
    ).select("n_blocking", (F.col("n_blocking") == 0).alias("passed"))


def verdict(issue_df: DataFrame) -> DataFrame:
    """One row: ``pass`` / ``pass_with_warnings`` / ``fail`` from the worst severity."""
    worst = issue_df.agg(F.max(severity_rank(F.col("severity"))).alias("_w"))
    return worst.select(
        F.when(F.col("_w") == 2, "fail").when(F.col("_w") == 1, "pass_with_warnings")
        .otherwise("pass").alias("verdict"),
        F.coalesce(F.col("_w"), F.lit(0)).cast("long").alias("worst_rank"),
    )
