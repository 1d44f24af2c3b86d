"""Composite validators: sample table, project table, both together.

Each returns ``(validated DataFrame, issues DataFrame)``; both are lazy.  The
rule order matters and follows the manifest conventions: fill precedes the
vocabulary, layout synonyms precede the vocabulary, the file number is given
before the tail is trimmed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from manifestqc.functions.blank import not_blank
from manifestqc.functions.text import LAYOUT_SYNONYMS, SOURCE_SYNONYMS, canonicalize
from manifestqc.functions.vocab import (
    FILE_COLUMNS, PROJECT_ESSENTIAL, PROJECT_FILL_FIELDS, SAMPLE_ESSENTIAL, SAMPLE_FILL_FIELDS,
    VALID_OPTIONS,
)
from manifestqc.operators import reconcile as R
from manifestqc.operators import rules as U
from manifestqc.operators.issues import driver_issues, empty_issues, issues, strict_gate, union_issues
from manifestqc.operators.rows import number_and_trim, trim_tail
from manifestqc.session import materialize
from manifestqc.sources.config import effective_defaults

ROW = "_row"
LAYOUT = "_canonical_layout"


class MissingFiles(RuntimeError):
    """Raised by ``validate_pair(on_missing='fail')``."""


class FileNameMismatch(RuntimeError):
    """Raised by ``validate_pair(on_mismatch='fail')``."""


def key_issues(df: DataFrame, tbl: str, key: str, keys_checked: bool) -> list[DataFrame]:
    if keys_checked:
        return [R.missing_cell_issues(df, tbl, key)]
    return [R.duplicate_issues(df, tbl, key), R.alignment_issues(df, tbl, key)]


def validate_samples(df: DataFrame, config: Mapping | None = None, key: str = "sample_name",
                     options: Mapping[str, Iterable[str]] = VALID_OPTIONS, tbl: str = "sample",
                     materialize_input: bool = False, keys_checked: bool = False):
    """Sample table: ``(validated, issues)``.  ``materialize_input`` checkpoints
    the input once when both results will be used (each re-reads it).
    ``keys_checked``: duplicates are reported by the caller and no row is without a key (so nothing lies below the last)."""
    if materialize_input:
        df = materialize(df)
    defaults = effective_defaults(config)
    # Row-level rules, all in one scan of the input: vocabulary on the values
    # after fill/ensure/synonyms, layout-vs-mate on the values after the
    # vocabulary (the order of the rules is kept by staging the expressions).
    vals = U.staged_values(df, SAMPLE_FILL_FIELDS, SAMPLE_ESSENTIAL, defaults)
    checked = df
    if "library_layout" in vals:
        # a column of its own below the rules: they name it many times over, and it is trimmed by a regular expression
        checked = df.withColumn(LAYOUT, canonicalize(vals["library_layout"], LAYOUT_SYNONYMS))
        vals["library_layout"] = F.col(LAYOUT)
    specs = U.vocab_specs(vals, options, defaults)
    if {"library_layout", "filename", "filename2"} <= set(vals):
        lay = vals["library_layout"]
        if "library_layout" in options:
            lay = U.enforced(lay, options["library_layout"], defaults.get("library_layout"))
        specs.append(U.layout_mate_spec(lay, vals["filename2"]))
    found = [*key_issues(df, tbl, key, keys_checked), U.row_issues(checked, specs, tbl, key)]
    out = U.fill_defaults(df, SAMPLE_FILL_FIELDS, defaults)
    out = U.ensure_columns(out, SAMPLE_ESSENTIAL, defaults)
    out = U.canonical_layout(out)
    out = U.enforce_vocab(out, options, defaults)
    out = U.fill_from_column(out, "library_ID", key)
    if key in out.columns and ROW in out.columns:
        out = trim_tail(out, key)
    return out, union_issues(found)


def validate_projects(df: DataFrame, config: Mapping | None = None, key: str = "sample_name",
                      options: Mapping[str, Iterable[str]] = VALID_OPTIONS, tbl: str = "project",
                      materialize_input: bool = False, keys_checked: bool = False):
    """Project table: ``(validated, issues)``; see ``validate_samples``."""
    if materialize_input:
        df = materialize(df)
    defaults = effective_defaults(config)
    # Row-level rules in one scan: blank dates on the raw values, vocabulary
    # after fill/ensure, host after the source synonyms.
    vals = U.staged_values(df, PROJECT_FILL_FIELDS, PROJECT_ESSENTIAL, defaults)
    specs = []
    if "collection_date" in df.columns:
        specs.append(U.blank_date_spec(F.col("collection_date")))
    specs += U.vocab_specs(vals, options, defaults)
    if "sample_source" in vals and "host" in vals:
        specs.append(U.host_spec(canonicalize(vals["sample_source"], SOURCE_SYNONYMS), vals["host"]))
    found = [*key_issues(df, tbl, key, keys_checked), U.row_issues(df, specs, tbl, key)]
    # The number and the trim depend on positions and keys as they came, so they come first and the rules run above them once.
    numbered = ROW in df.columns and "file_number" not in df.columns
    out = number_and_trim(df, key if key in df.columns else None, "file_number", ROW, start=1) if ROW in df.columns else df
    out = U.fill_defaults(out, PROJECT_FILL_FIELDS, defaults)
    out = U.ensure_columns(out, PROJECT_ESSENTIAL, defaults)
    out = U.enforce_vocab(out, options, defaults)
    out = U.date_column(out, "collection_date", defaults.get("collection_date"))
    out = U.geo_column(out)
    out = U.latlon_column(out)
    out = U.canonical_source(out)
    if numbered:
        out = out.select(*[c for c in out.columns if c != "file_number"], "file_number")
    return out, union_issues(found)


def drop_blank_keys(df: DataFrame, key: str = "sample_name") -> DataFrame:
    return df.filter(not_blank(F.col(key))) if key in df.columns else df


def table_issues(df: DataFrame, tbl: str, key: str = "sample_name", file_columns: Sequence[str] = FILE_COLUMNS,
                 blank_key_message: str = "row without a key is left out") -> list[DataFrame]:
    """What is wrong with a table as it was read: key and file columns that are not there, lines of another width, open
    quotes, rows without a key."""
    found = [U.required_column_issues(df, [key], tbl),
             U.row_width_issues(df, len([c for c in df.columns if c not in R.HELPER_COLUMNS]), tbl, key),
             U.open_quote_issues(df, tbl, key)]
    if key in df.columns:
        found.append(issues(df, ~not_blank(F.col(key)), "blank_key", tbl, col=key, row=F.col(ROW) if ROW in df.columns else None,
                            message=blank_key_message, severity="info"))
    if not any(c in df.columns for c in file_columns):
        found.append(driver_issues(df.sparkSession, [("file_columns", tbl, None, None, None, None, "no file columns", "warning")]))
    return found


def check_policy(on_missing: str) -> None:
    if on_missing not in ("report", "drop", "fail"):
        raise ValueError("on_missing must be 'report', 'drop' or 'fail'")


def missing_under(missing: DataFrame, on_missing: str, tbl: str) -> tuple[DataFrame, DataFrame]:
    """``(missing, issues)`` of missing references under a policy; ``fail`` raises ``MissingFiles`` if there are any."""
    if on_missing == "drop":
        missing = materialize(missing)
        return missing, issues(missing, None, "removed_sample", tbl, col=F.col("column"), key=F.col("key"), row=F.col(ROW), value=F.col("path"),
                               message="sample removed: referenced file not found", severity="info")
    if on_missing == "fail" and not missing.isEmpty():
        raise MissingFiles("referenced files are missing; see missing_files()")
    return missing, R.missing_file_issues(missing, tbl)


def validate_table(table: DataFrame, config: Mapping | None = None, tbl: str = "sample",
                   inventory: DataFrame | Callable[[DataFrame], DataFrame] | None = None, base: str | None = None,
                   key: str = "sample_name", on_missing: str = "report", file_columns: Sequence[str] = FILE_COLUMNS,
                   options: Mapping[str, Iterable[str]] = VALID_OPTIONS):
    """One table on its own: ``(validated, issues)``, with the issues and the ``on_missing`` policies of ``validate_pair``.

    Rows without a key stay where later rows have one, as the table's own validator keeps them."""
    check_policy(on_missing)
    found = table_issues(table, tbl, key, file_columns, "row without a key")
    table = materialize(table)
    if inventory is not None:
        refs = R.file_refs(table, key, file_columns, base)
        missing, of_missing = missing_under(R.missing_files(refs, inventory(refs) if callable(inventory) else inventory), on_missing, tbl)
        found.append(of_missing)
        if on_missing == "drop" and key in table.columns:
            table = materialize(R.remove_samples(table, missing.select("key"), key))
    out, more = (validate_projects if tbl == "project" else validate_samples)(table, config, key, options)
    return out, union_issues([*found, more])


def validate_pair(project: DataFrame, sample: DataFrame, config: Mapping | None = None,
                  inventory: DataFrame | Callable[[DataFrame], DataFrame] | None = None, base: str | None = None,
                  key: str = "sample_name", on_missing: str = "report", on_mismatch: str = "report",
                  file_columns: Sequence[str] = FILE_COLUMNS,
                  options: Mapping[str, Iterable[str]] = VALID_OPTIONS, cut: Callable[[DataFrame], DataFrame] = materialize):
    """Validate and reconcile both tables: ``(project, sample, issues)``.

    ``on_missing``: ``report`` keeps samples with missing files, ``drop``
    removes them from both tables, ``fail`` raises ``MissingFiles`` when any
    referenced file is missing (one short existence job).  ``on_mismatch``:
    ``fail`` raises ``FileNameMismatch`` when the tables name different files
    for a sample.  Strictness is
    applied by the caller with ``strict_gate(issues)`` before anything is
    written.

    ``inventory`` is a table of existing paths, or a function from the file
    references to one.  Nothing goes silently: rows without a key are reported
    (``blank_key``) and so are lines of another width than the header
    (``row_width``), quotes that are not closed (``open_quote``), a table without the key column (``required_columns``; its
    key rules are skipped) or without file columns (``file_columns``), and, with
    ``drop``, each missing file of a removed sample (``removed_sample``).  ``cut`` stores what several branches read."""
    check_policy(on_missing)
    if on_mismatch not in ("report", "fail"):
        raise ValueError("on_mismatch must be 'report' or 'fail'")
    # Each table feeds several rule branches: store it once (reliable,
    # shared checkpoint folder) instead of recomputing its lineage per branch.
    project, sample = cut(project), cut(sample)
    found = []
    for df, tbl in ((project, "project"), (sample, "sample")):
        found += table_issues(df, tbl, key, file_columns)
    keyed = key in project.columns and key in sample.columns
    project, sample = drop_blank_keys(project, key), drop_blank_keys(sample, key)
    if inventory is not None:
        refs = R.file_refs(sample, key, file_columns, base)
        missing, of_missing = missing_under(R.missing_files(refs, inventory(refs) if callable(inventory) else inventory), on_missing, "sample")
        found.append(of_missing)
        if on_missing == "drop":
            bad = missing.select("key")
            sample, project = (cut(R.remove_samples(t, bad, key)) for t in (sample, project))
    if keyed:
        # Everything per key comes from one aggregate over both tables.
        summary = cut(R.key_summary(sample, project, key, file_columns))
        mm = R.summary_mismatches(summary, [c for c in file_columns if c in sample.columns and c in project.columns])
        if on_mismatch == "fail" and not mm.isEmpty():
            raise FileNameMismatch("file names differ between the tables; see filename_mismatch()")
        found += [issues(mm, None, "filename_mismatch", "both", col=F.col("column"), key=F.col("key"),
                         value=F.concat_ws(" | ", "sample_file", "project_file"),
                         message="file names differ between the tables", severity="warning"),
                  R.summary_coverage_issues(summary, key),
                  R.summary_duplicate_issues(summary, sample, project, key)]
    p_out, p_issues = validate_projects(project, config, key, options, keys_checked=keyed)
    s_out, s_issues = validate_samples(sample, config, key, options, keys_checked=keyed)
    return p_out, s_out, union_issues(found + [p_issues, s_issues])


def strict_passes(issue_df: DataFrame) -> bool:
    """Driver-side gate check (one small aggregate row)."""
    return bool(strict_gate(issue_df).first()["passed"])


REQUIRED_SAMPLE = ("sample_name", "library_ID", "filename", "filename2")


def clean_report(sample: DataFrame, project: DataFrame, inventory: DataFrame, base: str,
                 required: Sequence[str] = REQUIRED_SAMPLE, key: str = "sample_name",
                 n_header: int | None = None):
    """Post-clean report: required columns (error), short rows (warning, and
    those rows are not checked further), missing files (error), row-count
    parity (error).  ``(issues, verdict)``."""
    spark = sample.sparkSession
    found = [U.required_column_issues(sample, required, "sample")]
    width_cols = [c for c in sample.columns if c not in R.HELPER_COLUMNS]
    n_cols = n_header or len(width_cols)
    if "_width" in sample.columns:
        short = F.col("_width") < n_cols
        found.append(issues(sample, short, "row_width", "sample", key=F.col(key) if key in sample.columns else None,
                            row=F.col(ROW) if ROW in sample.columns else None,
                            value=F.col("_width").cast("string"), message="insufficient fields",
                            severity="warning"))
        checked = sample.filter(~short)
    else:
        checked = sample
    refs = R.file_refs(checked, key, [c for c in ("filename", "filename2") if c in sample.columns], base)
    found.append(R.missing_file_issues(R.missing_files(refs, inventory), "sample"))
    parity = R.count_parity(sample, project)
    found.append(issues(parity, ~F.col("equal"), "count_parity", "both",
                        value=F.concat_ws(" vs ", F.col("n_a").cast("string"), F.col("n_b").cast("string")),
                        message="row counts differ", severity="error"))
    all_issues = union_issues(found)
    from manifestqc.operators.issues import verdict
    return all_issues, verdict(all_issues)


__all__ = ["validate_samples", "validate_projects", "validate_pair", "validate_table", "table_issues", "drop_blank_keys",
           "strict_passes", "clean_report", "empty_issues", "driver_issues"]
