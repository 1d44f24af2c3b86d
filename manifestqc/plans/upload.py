"""Upload planning: files to send, pending work, batches, accounting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from manifestqc.functions.vocab import FILE_COLUMNS
from manifestqc.operators import ledger as L
from manifestqc.operators import reconcile as R


def collect_files(sample: DataFrame, inventory: DataFrame, base: str | None = None,
                  key: str = "sample_name", file_columns: Sequence[str] = FILE_COLUMNS) -> DataFrame:
    """Files referenced by the sample table that exist, each once, with the
    position of its first reference: ``(path, first_row, first_pos)``."""
    refs = R.file_refs(sample, key, file_columns, base)
    return L.distinct_files(R.found_files(refs, inventory))


def upload_list(sample: DataFrame, base: str, key: str = "sample_name",
                columns: Sequence[str] = ("filename", "filename2")) -> DataFrame:
    """Flat list of the paths named in the given columns, joined to ``base``."""
    return R.file_refs(sample, key, columns, base).select("path", "key", "_row", "column")


def plan_upload(files: DataFrame, ledger: DataFrame, batch_size: int = 50,
                order: Sequence[str] = ("first_row", "first_pos")) -> DataFrame:
    """Pending files (not uploaded yet) in first-reference order, in batches."""
    return L.plan_batches(L.pending_files(files, ledger), [c for c in order if c in files.columns], batch_size)
