"""The spark-submit entry points, each in its own process (own catalog
session): runs written by one process are seen by the next."""

import json
import os
import subprocess
import sys
import uuid

from scorewell.plans import fixtures as fx
from scorewell.session import scratch_location
from tests.conftest import ROOT, SF_SMALL

M1 = json.dumps({"weights": {"f_price": 0.0009765625, "f_priority": 0.5, "f_month": 0.25}})
M2 = json.dumps({"weights": {"f_price": 0.00000762939453125, "f_priority": -0.25,
                             "f_month": 0.125}, "link": "logistic"})


def run(module, *args):
    env = dict(os.environ, PYTHONPATH=ROOT)
    out = subprocess.run([sys.executable, "-m", module, *args], cwd=ROOT, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    return out.stderr


def test_score_score_merge_in_separate_processes(spark):
    base = scratch_location(spark, "cli")
    features = f"{base}/features"
    fx.features(spark, SF_SMALL).write.parquet(features)
    db, loc = f"cli_{uuid.uuid4().hex[:8]}", f"{base}/db"
    common = ["--input-path", features, "--database", db, "--run-id", "20260101_000000",
              "--location", loc]
    run("scorewell.jobs.score_job", "--model-name", "model_1", "--table-name",
        "model_1_scores", "--model-spec", M1, *common)
    run("scorewell.jobs.score_job", "--model-name", "model_2", "--table-name",
        "model_2_scores", "--model-spec", M2, *common)
    log = run("scorewell.jobs.merge_job", "--database", db, "--model1-table", "model_1_scores",
              "--model2-table", "model_2_scores", "--merged-table", "merged_model_scores",
              "--run-id", "20260101_000000", "--location", loc)
    assert "merged 1500 rows" in log
    again = run("scorewell.jobs.merge_job", "--database", db, "--model1-table",
                "model_1_scores", "--model2-table", "model_2_scores", "--merged-table",
                "merged_model_scores", "--run-id", "20260101_000000", "--location", loc)
    assert "already merged" in again
    merged = spark.read.parquet(f"{loc}/merged_model_scores")
    assert merged.count() == 1500
    daily = run("scorewell.jobs.daily_run", "--database", f"{db}_d", "--input-path", features,
                "--execution-date", "2026-01-02T00:00:00", "--model1-spec", M1,
                "--model2-spec", M2, "--location", f"{base}/daily")
    assert "run 20260102_000000: rows=1500" in daily
