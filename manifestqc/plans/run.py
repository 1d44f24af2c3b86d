"""End-to-end flows over files: validate a project + sample manifest pair and
write the validated tables; generate starter tables from a folder of
sequence files."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from manifestqc.operators.issues import issue_summary, strict_gate
from manifestqc.operators.pairs import build_samples, detect_pairs, project_template
from manifestqc.plans.validate import check_policy, validate_pair, validate_table
from manifestqc.session import forget, kept, materialize
from manifestqc.sources.config import effective_options
from manifestqc.sources.files import existing_files, qualified
from manifestqc.sources.manifest import list_files, read_manifest, write_manifest

VALIDATED_PREFIX = "validated-"


def _out_name(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    stem = os.path.splitext(base)[0]
    return VALIDATED_PREFIX + stem


def validate_files(spark: SparkSession, project_path: str | None, sample_path: str | None = None, config: Mapping | None = None,
                   file_dir: str | None = None, output_dir: str | None = None, strict: bool = False,
                   on_missing: str = "report", na_tokens=(), options=None,
                   inventory: DataFrame | None = None, base: str | None = None):
    """Read both manifests, validate and reconcile them, gate, then write.

    Returns ``(project, sample, issues, passed)``.  With ``strict`` nothing is
    written unless the gate passes (the gate runs before any write).  Outputs
    go to ``<output_dir>/validated-<name>`` as tab-delimited folders.  With
    ``file_dir`` every referenced file is probed where it is, relative names
    under that folder; ``inventory`` gives any ``(path)`` table instead, with
    ``base`` for relative names.  Without ``sample_path`` (or ``project_path``)
    the one table is validated on its own, under the same ``on_missing`` policies and with the same
    issues.  The config's own default instrument
    extends the vocabulary."""
    from manifestqc.functions.vocab import VALID_OPTIONS
    options = effective_options(config, options or VALID_OPTIONS)
    check_policy(on_missing)
    if file_dir and base is None:
        base = qualified(spark, file_dir)
    probed = inventory if inventory is not None or not file_dir else lambda refs: materialize(existing_files(refs))
    if not (project_path and sample_path):
        if not (project_path or sample_path):
            raise ValueError("name a project or a sample table")
        read = read_manifest(spark, project_path or sample_path, na_tokens=na_tokens, open_quotes=True)
        table = kept(read)
        forget(read)
        if table.isEmpty():
            raise ValueError(f"no rows in {project_path or sample_path}")
        out, found = validate_table(table, config, "project" if project_path else "sample", probed, base, on_missing=on_missing, options=options)
        found = kept(found)
        passed = bool(strict_gate(found).first()["passed"])
        if output_dir and (passed or not strict):
            write_manifest(out, os.path.join(output_dir, _out_name(project_path or sample_path)))
        return (out if project_path else None), (out if sample_path else None), found, passed
    project = read_manifest(spark, project_path, na_tokens=na_tokens, open_quotes=True)
    sample = read_manifest(spark, sample_path, na_tokens=na_tokens, open_quotes=True)
    p_out, s_out, found = validate_pair(project, sample, config, inventory=probed, base=base,
                                        on_missing=on_missing, options=options, cut=kept)
    forget(project)
    forget(sample)  # the lines as they were read; the tables are kept
    found = kept(found)  # read by the gate, the summary and the caller
    passed = bool(strict_gate(found).first()["passed"])
    if output_dir and (passed or not strict):
        write_manifest(p_out, os.path.join(output_dir, _out_name(project_path)))
        write_manifest(s_out, os.path.join(output_dir, _out_name(sample_path)))
    return p_out, s_out, found, passed


def summary(found: DataFrame) -> DataFrame:
    return issue_summary(found)


def generate_templates(spark: SparkSession, file_dir: str, output_dir: str,
                       config: Mapping | None = None) -> tuple[str, str]:
    """Starter tables from a folder of sequence files: the sample table built
    from detected pairs and a one-row project template from the defaults."""
    files = list_files(spark, file_dir)
    samples = build_samples(detect_pairs(files), config)
    sample_out = os.path.join(output_dir, "sample-metadata-template")
    project_out = os.path.join(output_dir, "bioproject-metadata-template")
    write_manifest(samples, sample_out, order_col=None)
    write_manifest(project_template(spark, config), project_out, order_col=None)
    return sample_out, project_out
