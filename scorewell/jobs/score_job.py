"""spark-submit entry: score one model into its run partition.

    spark-submit scorewell/jobs/score_job.py --model-name model_1 \\
        --input-path /data/input/features --database model_scoring \\
        --table-name model_1_scores --run-id 20260101_000000 \\
        --model-spec '{"weights": {"f_price": 0.001}, "link": "identity"}'
"""

from __future__ import annotations

import argparse
import logging

from scorewell.jobs.cli import load_model, resolve_version
from scorewell.plans.jobs import score_job
from scorewell.session import get_session

log = logging.getLogger("scorewell")


def parse(argv=None):
    p = argparse.ArgumentParser(description="Score a feature set into a run partition")
    p.add_argument("--model-name", required=True)
    p.add_argument("--model-stage", default="Production")
    p.add_argument("--input-path", required=True, help="Parquet feature set")
    p.add_argument("--database", required=True)
    p.add_argument("--table-name", required=True)
    p.add_argument("--run-id", required=True)
    p.add_argument("--registry-table", help="table (name, stage, version) to resolve the model")
    p.add_argument("--model-spec", help="JSON (inline or file) for a linear/logistic model")
    p.add_argument("--model-factory", help="module:function returning a model")
    p.add_argument("--location", help="database location for first use")
    p.add_argument("--force", action="store_true", help="rescore a run that is done")
    return p.parse_args(argv)


def main(argv=None) -> int:
    logging.basicConfig(level=logging.INFO)
    args = parse(argv)
    spark = get_session(app_name=f"scorewell score {args.model_name}")
    try:
        uri, version = resolve_version(spark, args.registry_table, args.model_name,
                                       args.model_stage)
        model = load_model(args.model_name, args.model_spec, args.model_factory, uri)
        res = score_job(spark, model, args.input_path, args.database, args.table_name,
                        args.run_id, force=args.force, location=args.location)
        if res.skipped:
            log.info("run %s already done in %s; skipped", args.run_id, res.table)
        else:
            log.info("scored %s rows into %s run %s (model version %s)", res.rows, res.table,
                     args.run_id, version)
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    raise SystemExit(main())
