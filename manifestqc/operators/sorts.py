"""Previews: the first N items in an order plus how many there are.

A preview is a report feature (the whole set stays available); the top-N is
a ``TakeOrderedAndProject`` (global) or a window limited per group, which
Catalyst turns into a partial ``WindowGroupLimit`` before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def preview(df: DataFrame, order: Sequence[str], n: int = 10, total_name: str = "n_total") -> DataFrame:
    """First ``n`` rows by ``order`` with the total row count as a column."""
    total = df.agg(F.count(F.lit(1)).cast("long")).scalar()
    return df.orderBy(*order).limit(n).withColumn(total_name, total)


def preview_per_group(df: DataFrame, key: str, order: Sequence[str], n: int = 5,
                      rest_name: str = "n_more") -> DataFrame:
    """Up to ``n`` rows per key by ``order`` and, per key, how many more exist."""
    w = Window.partitionBy(key).orderBy(*order)
    top = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
    counts = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    joined = top.join(counts, top[key].eqNullSafe(counts["_k"]))
    return joined.withColumn(rest_name, F.greatest(F.col("_n") - F.lit(n), F.lit(0)).cast("long")) \
                 .drop("_k", "_n")
