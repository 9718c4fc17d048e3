"""spark-submit entry: the whole daily run in one session.

Score both models, validate each, merge, validate the merge, store the
validation report and fail on any failed check.  The run id is given, or
derived from the execution time (``yyyyMMdd_HHmmss``, UTC).

    spark-submit scorewell/jobs/daily_run.py --database model_scoring \\
        --input-path /data/input/features --execution-date 2026-01-01T00:00:00 \\
        --model1-spec m1.json --model2-spec m2.json
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging

from scorewell.contracts import check_run_id
from scorewell.functions.columns import run_id_for
from scorewell.jobs.cli import load_model, resolve_version
from scorewell.plans.jobs import ModelRun, PipelineConfig, run_pipeline
from scorewell.session import get_session

log = logging.getLogger("scorewell")


def parse(argv=None):
    p = argparse.ArgumentParser(description="Score two models, merge, validate")
    p.add_argument("--database", required=True)
    p.add_argument("--input-path", required=True)
    g = p.add_mutually_exclusive_group(required=True)
    g.add_argument("--run-id")
    g.add_argument("--execution-date", help="ISO time; run id = yyyyMMdd_HHmmss (UTC)")
    for k in ("1", "2"):
        p.add_argument(f"--model{k}-name", default=f"model_{k}")
        p.add_argument(f"--model{k}-stage", default="Production")
        p.add_argument(f"--model{k}-spec")
        p.add_argument(f"--model{k}-factory")
        p.add_argument(f"--model{k}-input-path", help="defaults to --input-path")
    p.add_argument("--registry-table")
    p.add_argument("--merged-table", default="merged_model_scores")
    p.add_argument("--report-table", default="validation_report")
    p.add_argument("--ledger-table", help="record each step there, and skip and resume by it")
    p.add_argument("--max-null-fraction", type=float, default=0.05)
    p.add_argument("--no-strict", action="store_true")
    p.add_argument("--location")
    p.add_argument("--force", action="store_true")
    return p.parse_args(argv)


def main(argv=None) -> int:
    logging.basicConfig(level=logging.INFO)
    args = parse(argv)
    run_id = args.run_id or run_id_for(dt.datetime.fromisoformat(args.execution_date))
    check_run_id(run_id)
    spark = get_session(app_name=f"scorewell daily run {run_id}")
    try:
        runs = []
        for k in ("1", "2"):
            name = getattr(args, f"model{k}_name")
            uri, version = resolve_version(spark, args.registry_table, name,
                                     getattr(args, f"model{k}_stage"))
            model = load_model(name, getattr(args, f"model{k}_spec"),
                               getattr(args, f"model{k}_factory"), uri)
            runs.append(ModelRun(model, getattr(args, f"model{k}_input_path") or args.input_path,
                                 version=None if version is None else str(version)))
        cfg = PipelineConfig(
            database=args.database, models=(runs[0], runs[1]), merged_table=args.merged_table,
            report_table=args.report_table, ledger_table=args.ledger_table, location=args.location, strict=not args.no_strict,
            max_null_fraction=args.max_null_fraction,
        )
        res = run_pipeline(spark, cfg, run_id, force=args.force)
        for job in res.jobs:
            log.info("%s run %s: rows=%s skipped=%s", job.table, run_id, job.rows, job.skipped)
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    raise SystemExit(main())
