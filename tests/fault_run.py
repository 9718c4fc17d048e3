"""Run a score job and a strict merge while tasks fail; print the counts as JSON.

Started by ``test_faults`` in its own process: the session is
``local[4,4]`` (4 attempts per task), and the model raises on the first
attempt of every task, as a task on a lost executor would, so every stage
that scores re-runs its tasks.  The ensemble rule fails the same way, so
the merge's post-shuffle stage - where its join counts are observed - re-runs
too.  Usage: ``python -m tests.fault_run SF_DIR``.
"""

import json
import sys

import pandas as pd
from pyspark import TaskContext
from pyspark.sql.functions import pandas_udf

from scorewell.functions.models import PythonModel
from scorewell.plans import fixtures as fx
from scorewell.plans.jobs import merge_job, score_job
from scorewell.session import checkpoint_root, get_session, scratch_location, unique_name
from scorewell.sources.catalog import ensure_database, read_run


def flaky(predict):
    def run(pdf):
        ctx = TaskContext.get()
        if ctx is not None and ctx.attemptNumber() == 0:
            raise RuntimeError("injected task failure")
        return predict(pdf)

    return run


def flaky_ensemble(scores):
    """Mean of the scores through a pandas UDF that fails like ``flaky``."""

    @pandas_udf("double")
    def mean(a: pd.Series, b: pd.Series) -> pd.Series:
        ctx = TaskContext.get()
        if ctx is not None and ctx.attemptNumber() == 0:
            raise RuntimeError("injected task failure")
        return (a + b) / 2.0

    return mean(*scores)


def main(sf):
    spark = get_session("local[4,4]", shuffle_partitions=4,
                        conf={"spark.sql.files.maxPartitionBytes": "16k"})
    checkpoint_root(spark)
    db = unique_name("faults")
    ensure_database(spark, db, location=scratch_location(spark, db))
    f, f2 = fx.features(spark, sf), fx.model_2_features(spark, sf)
    m2 = fx.MODEL_2
    m1 = PythonModel("model_1", flaky(fx.MODEL_1.as_python().predict),
                     features=tuple(fx.MODEL_1.features))
    m2 = PythonModel("model_2", flaky(m2.predict), features=m2.features)
    sc = spark.sparkContext
    sc.setJobGroup("score_1", "score model 1")
    j1 = score_job(spark, m1, f, db, "model_1_scores", fx.RUN, now=fx.NOW)
    sc.setJobGroup("score_2", "score model 2")
    j2 = score_job(spark, m2, f2, db, "model_2_scores", fx.RUN, now=fx.NOW)
    sc.setJobGroup("merge", "merge")
    merged = merge_job(spark, db, fx.RUN, now=fx.NOW, ensemble=flaky_ensemble)
    sc.setJobGroup("check", "check")
    tracker = sc.statusTracker()

    def failed_tasks(group):
        stages = [s for j in tracker.getJobIdsForGroup(group)
                  for s in (tracker.getJobInfo(j).stageIds if tracker.getJobInfo(j) else [])]
        return sum(tracker.getStageInfo(s).numFailedTasks for s in stages
                   if tracker.getStageInfo(s))

    failed = {g: failed_tasks(g) for g in ("score_1", "score_2", "merge")}
    out = {
        "splits": f.rdd.getNumPartitions(),
        "features": f.count(),
        "model_2_features": f2.count(),
        "written_1": j1.rows,
        "written_2": j2.rows,
        "stored_1": read_run(spark, f"{db}.model_1_scores", fx.RUN).count(),
        "stored_2": read_run(spark, f"{db}.model_2_scores", fx.RUN).count(),
        "merged_written": merged.rows,
        "merged_stored": read_run(spark, f"{db}.merged_model_scores", fx.RUN).count(),
        "join": merged.details["join"],
        "failed_tasks": failed,
    }
    print("FAULT_RESULT " + json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
