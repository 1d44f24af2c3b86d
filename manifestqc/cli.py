"""Command line: ``python -m manifestqc validate|templates ...``.

A thin wrapper over ``manifestqc.plans.run``; all work happens in Spark."""

from __future__ import annotations

import argparse
import json
import sys

from manifestqc.sources.config import load_config


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="manifestqc")
    sub = ap.add_subparsers(dest="cmd", required=True)
    v = sub.add_parser("validate", help="validate and reconcile a project + sample manifest pair")
    v.add_argument("--project", help="project table; it or --sample may be left out")
    v.add_argument("--sample")
    v.add_argument("--config")
    v.add_argument("--file-dir", help="folder holding the referenced sequence files")
    v.add_argument("--output-dir")
    v.add_argument("--strict", action="store_true", help="write nothing and exit 1 when the gate fails")
    v.add_argument("--on-missing", choices=["report", "drop", "fail"], default="report")
    v.add_argument("--instrument", help="one extra accepted instrument_model value")
    t = sub.add_parser("templates", help="starter tables from a folder of sequence files")
    t.add_argument("--file-dir", required=True)
    t.add_argument("--output-dir", required=True)
    t.add_argument("--config")
    args = ap.parse_args(argv)

    from manifestqc.session import submitted_session
    spark = submitted_session()
    cfg = load_config(args.config, spark)
    if args.cmd == "templates":
        from manifestqc.plans.run import generate_templates
        print(json.dumps(dict(zip(("sample", "project"),
                                  generate_templates(spark, args.file_dir, args.output_dir, cfg)))))
        return 0
    from manifestqc.functions.vocab import VALID_OPTIONS, extend_vocabulary
    from manifestqc.plans.run import summary, validate_files
    options = extend_vocabulary(VALID_OPTIONS, "instrument_model", args.instrument)
    _, _, found, passed = validate_files(spark, args.project, args.sample, cfg, file_dir=args.file_dir,
                                         output_dir=args.output_dir, strict=args.strict,
                                         on_missing=args.on_missing, options=options)
    for r in summary(found).orderBy("rule").collect():
        print(f"{r.rule}\t{r.severity}\t{r.n_issues}")
    return 1 if (args.strict and not passed) else 0


if __name__ == "__main__":
    sys.exit(main())
