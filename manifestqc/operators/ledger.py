"""Upload planning and accounting over tables.

The copy itself happens outside Spark; what is data work is: which files are
still pending, how they are cut into batches, what the final status of each
file is after a series of batch / per-file attempts, how that merges into the
progress ledger, and the completion summary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from manifestqc.operators.rows import assign_batches

UPLOADED = "uploaded"
FAILED = "failed"


def distinct_files(refs: DataFrame, path_col: str = "path", order_cols=("_row", "col_pos")) -> DataFrame:
    """Distinct paths with their first occurrence ``(first_row, first_pos)``;
    ``min(struct)`` is a partial aggregate, so repeats cost one row per task."""
    first = F.min(F.struct(*[F.col(c) for c in order_cols])).alias("_first")
    return refs.groupBy(F.col(path_col).alias("path")).agg(first).select(
        "path", F.col("_first._row").alias("first_row"), F.col("_first.col_pos").alias("first_pos"))


def pending_files(files: DataFrame, ledger: DataFrame, path_col: str = "path") -> DataFrame:
    """Files not yet uploaded according to the ledger (anti-join)."""
    done = ledger.filter(F.col("status") == UPLOADED).select(F.col("path").alias(path_col))
    return files.join(done, path_col, "left_anti")


def plan_batches(pending: DataFrame, order_col: str | Sequence[str], batch_size: int) -> DataFrame:
    """Pending files in order, cut into batches of ``batch_size``.  The
    pending set (an anti-join) is checkpointed once before numbering."""
    return assign_batches(pending, order_col, batch_size, materialize_input=True)


def reduce_attempts(attempts: DataFrame, batches: DataFrame) -> DataFrame:
    """Final status per file = outcome of its deciding attempt:
    ``(path, status, attempt_no)``.

    A file's own attempts (``path`` given) come after those of its batch
    (``path`` null), whatever their numbers, as the numbers start anew for each;
    within either the highest number decides.  Batch attempts are reduced to one
    row per batch before that row is given to the batch's files."""
    def last(df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(key).agg(F.max(F.struct("attempt_no", "ok")).alias("_last"))

    whole = last(attempts.filter(F.col("path").isNull()), "batch").join(batches.select("batch", "path"), "batch") \
        .select("path", F.lit(0).alias("_own"), "_last")
    own = last(attempts.filter(F.col("path").isNotNull()), "path").select("path", F.lit(1).alias("_own"), "_last")
    return whole.unionByName(own).groupBy("path").agg(F.max(F.struct("_own", "_last")).alias("_d")).select(
        "path", F.when(F.col("_d._last.ok"), F.lit(UPLOADED)).otherwise(F.lit(FAILED)).alias("status"),
        F.col("_d._last.attempt_no").alias("attempt_no"))


def merge_ledger(old: DataFrame, outcomes: DataFrame, folder: str, updated_at=None) -> DataFrame:
    """New ledger version: old rows plus new outcomes, newest status per path
    wins (uploaded replaces failed and the reverse).  ``(folder, path, status, updated_at)``."""
    ts = F.current_timestamp() if updated_at is None else F.lit(updated_at).cast("timestamp")
    new = outcomes.select(F.lit(folder).alias("folder"), "path", "status", ts.alias("updated_at"),
                          F.lit(1).alias("_gen"))
    prev = old.select("folder", "path", "status", "updated_at", F.lit(0).alias("_gen"))
    both = prev.unionByName(new)
    newest = F.max(F.struct("_gen", "updated_at", "status")).alias("_n")
    return both.groupBy("folder", "path").agg(newest).select(
        "folder", "path", F.col("_n.status").alias("status"), F.col("_n.updated_at").alias("updated_at"))


def upload_summary(files: DataFrame, ledger: DataFrame, path_col: str = "path") -> DataFrame:
    """One row: total, uploaded (of the files), failed, all_uploaded.
    All uploaded means every file is uploaded and nothing is failed."""
    def marks(df: DataFrame, path: str, is_file: bool, status) -> DataFrame:
        return df.select(F.col(path).alias("path"), F.lit(is_file).alias("_f"), (status == UPLOADED).alias("_u"), (status == FAILED).alias("_x"))

    # Files and ledger are stacked and meet in one aggregate by path, so either is evaluated once and moves once.
    both = marks(files, path_col, True, F.lit(None).cast("string")).unionByName(marks(ledger, "path", False, F.col("status")))
    per_path = both.groupBy("path").agg(*[F.coalesce(F.max(c), F.lit(False)).alias(c) for c in ("_f", "_u", "_x")])
    total = per_path.agg(F.count_if("_f").cast("long").alias("n_total"),
                         F.count_if(F.col("_f") & F.col("_u") & F.col("path").isNotNull()).cast("long").alias("n_uploaded"),
                         F.count_if("_x").cast("long").alias("n_failed"))
    return total.withColumn("all_uploaded", (F.col("n_uploaded") == F.col("n_total")) & (F.col("n_failed") == 0))


def failed_list(ledger: DataFrame) -> DataFrame:
    """Failed paths, sorted."""
    return ledger.filter(F.col("status") == FAILED).select("path").distinct().orderBy("path")
