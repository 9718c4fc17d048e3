"""spark-submit entry: merge two score sets of a run into the merged table.

    spark-submit scorewell/jobs/merge_job.py --database model_scoring \\
        --model1-table model_1_scores --model2-table model_2_scores \\
        --merged-table merged_model_scores --run-id 20260101_000000
"""

from __future__ import annotations

import argparse
import logging

from scorewell.plans.jobs import merge_job
from scorewell.session import get_session

log = logging.getLogger("scorewell")


def parse(argv=None):
    p = argparse.ArgumentParser(description="Merge two models' scores of one run")
    p.add_argument("--database", required=True)
    p.add_argument("--model1-table", required=True)
    p.add_argument("--model2-table", required=True)
    p.add_argument("--merged-table", required=True)
    p.add_argument("--run-id", required=True)
    p.add_argument("--model1-name", default="model_1")
    p.add_argument("--model2-name", default="model_2")
    p.add_argument("--no-strict", action="store_true",
                   help="allow duplicate ids (the join then multiplies rows)")
    p.add_argument("--location", help="database location for first use")
    p.add_argument("--force", action="store_true", help="re-merge a run that is done")
    return p.parse_args(argv)


def main(argv=None) -> int:
    logging.basicConfig(level=logging.INFO)
    args = parse(argv)
    spark = get_session(app_name="scorewell merge")
    try:
        res = merge_job(
            spark, args.database, args.run_id, args.model1_name, args.model2_name,
            tables=(args.model1_table, args.model2_table, args.merged_table),
            force=args.force, strict=not args.no_strict, location=args.location,
        )
        if res.skipped:
            log.info("run %s already merged in %s; skipped", args.run_id, res.table)
        else:
            log.info("merged %s rows into %s run %s; join %s", res.rows, res.table,
                     args.run_id, res.details.get("join"))
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    raise SystemExit(main())
