"""A run that fails to be replaced stays as it was; what other processes write is seen."""

import os
import subprocess
import sys

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from scorewell.contracts import score_contract
from scorewell.functions.columns import as_timestamp
from scorewell.functions.models import LinearModel, PythonModel
from scorewell.operators.checks import ValidationError, check_join
from scorewell.operators.merge import MergeMetrics, merge_unique, unmatched
from scorewell.operators.score import score, score_frame
from scorewell.plans.jobs import ModelRun, PipelineConfig, merge_job, run_pipeline, score_job
from scorewell.session import scratch_location
from scorewell.sources.catalog import ensure_database, read_run, run_exists, run_rows, write_run, write_runs
from scorewell.sources.registry import latest_versions
from tests.conftest import ROOT

M1 = LinearModel.of("model_1", {"x": 0.5})
M2 = LinearModel.of("model_2", {"x": 0.25})
NOW = "2026-01-01 12:00:00"


def feats(spark, ids):
    return spark.createDataFrame([(i, 1.0) for i in ids], "id string, x double")


def both(spark, db, a, b, force=False):
    score_job(spark, M1, feats(spark, a), db, "model_1_scores", "r1", now=NOW, force=force)
    score_job(spark, M2, feats(spark, b), db, "model_2_scores", "r1", now=NOW, force=force)


def test_failed_scoring_keeps_the_run(spark, db):
    def broken(pdf):
        raise RuntimeError("the model broke")

    score_job(spark, M1, feats(spark, "ab"), db, "model_1_scores", "r1", now=NOW)
    bad = PythonModel("model_1", broken, features=("x",))
    with pytest.raises(PySparkException, match="the model broke"):
        score_job(spark, bad, feats(spark, "xyz"), db, "model_1_scores", "r1", now=NOW, force=True)
    assert {r["id"] for r in read_run(spark, f"{db}.model_1_scores", "r1").collect()} == {"a", "b"}


def test_failed_merge_keeps_the_run(spark, db):
    both(spark, db, "ab", "ab")
    merge_job(spark, db, "r1", now=NOW)
    both(spark, db, "abb", "ab", force=True)
    with pytest.raises(ValueError, match="duplicate"):
        merge_job(spark, db, "r1", now=NOW, force=True)
    assert run_rows(spark, f"{db}.merged_model_scores", "r1") == 2


def test_empty_side_fails_before_the_write(spark, db):
    both(spark, db, "ab", "ab")
    merge_job(spark, db, "r1", now=NOW)
    both(spark, db, "", "ab", force=True)
    for strict in (True, False):
        with pytest.raises(ValueError, match="model_1_scores, run r1, has no rows"):
            merge_job(spark, db, "r1", now=NOW, force=True, strict=strict)
    assert run_rows(spark, f"{db}.merged_model_scores", "r1") == 2


def test_empty_frame_still_clears_a_stale_run(spark, db):
    both(spark, db, "abc", "")
    assert score_job(spark, M1, feats(spark, ""), db, "model_1_scores", "r1", now=NOW, force=True).rows == 0
    assert run_rows(spark, f"{db}.model_1_scores", "r1") == 0


def test_write_counts_its_rows_and_its_input(spark, db):
    job = score_job(spark, M1, feats(spark, "abcd"), db, "model_1_scores", "r1", now=NOW)
    assert job.rows == 4 and job.details["rows_in"] == 4


def test_backfill_refuses_bad_run_ids_and_keeps_the_others(spark, db):
    t = f"{db}.model_1_scores"
    frame = score_frame(feats(spark, "ab"), M1, now=NOW).withColumn("scoring_timestamp", F.col("scoring_timestamp").cast("timestamp"))
    write_run(frame, t, "r1", contract=score_contract("model_1"))
    for bad in (F.lit(None).cast("string"), F.lit("a b'c"), F.lit("r1\n")):
        with pytest.raises(PySparkException, match="invalid run_id"):
            write_runs(frame.withColumn("run_id", F.when(F.col("id") == "a", F.lit("r1")).otherwise(bad)), t)
    assert run_rows(spark, t, "r1") == 2


@pytest.mark.parametrize("pick", [lambda d: d.count(), lambda d: d.select("id").collect(), lambda d: d.collect()])
@pytest.mark.parametrize("left, right", [("aab", "ab"), ("aab", "b"), ("b", "aab")])
def test_any_duplicate_fails_whatever_is_selected(spark, pick, left, right):
    s1, s2 = score_frame(feats(spark, left), M1, now=NOW), score_frame(feats(spark, right), M2, now=NOW)
    with pytest.raises(PySparkException, match="duplicate id in merge inputs: a"):
        pick(merge_unique(s1, s2, now=NOW))


def test_null_keys_are_no_duplicates(spark):
    s1, s2 = score_frame(feats(spark, ["a", None, None]), M1, now=NOW), score_frame(feats(spark, ["a", None]), M2, now=NOW)
    m = MergeMetrics()
    assert merge_unique(s1, s2, now=NOW, metrics=m).count() == 1
    assert m.get()["dup_ids"] == check_join(s1, s2).first()["dup_ids"] == 0
    got = {(r["id"], r["missing_from"]): r["copies"] for r in unmatched(s1, s2).collect()}
    assert got == {(None, "model_2"): 2, (None, "model_1"): 1}


def test_join_above_the_given_size_is_refused(spark, db):
    both(spark, db, "aab", "aab")
    with pytest.raises(ValueError, match="would have 5 rows, more than 4"):
        merge_job(spark, db, "r1", now=NOW, strict=False, most_rows=4)
    assert merge_job(spark, db, "r1", now=NOW, strict=False, most_rows=5).rows == 5


def test_merged_run_that_its_gate_refused_is_merged_again(spark, db):
    cfg = lambda b: PipelineConfig(database=db, models=(ModelRun(M1, feats(spark, "ab")), ModelRun(M2, feats(spark, b))))
    with pytest.raises(ValidationError, match="matched"):
        run_pipeline(spark, cfg("xy"), "r1", now=NOW)
    score_job(spark, M2, feats(spark, "ab"), db, "model_2_scores", "r1", now=NOW, force=True)
    res = run_pipeline(spark, cfg("ab"), "r1", now=NOW)
    assert not res.jobs[2].skipped and res.merged.count() == 2


OTHER = """
import sys
from scorewell.functions.models import LinearModel
from scorewell.plans.jobs import score_job
from scorewell.session import get_session
spark = get_session("local[2]", shuffle_partitions=2)
m = LinearModel.of("model_1", {"x": 0.5})
f = spark.createDataFrame([("a", 1.0)], "id string, x double")
score_job(spark, m, f, "shared", "model_1_scores", "r2", now="2026-01-01 12:00:00", location=sys.argv[1])
spark.stop()
"""


def test_open_session_sees_the_run_of_another_process(spark, tmp_path):
    place = scratch_location(spark, "shared")
    ensure_database(spark, "shared", location=place)
    score_job(spark, M1, feats(spark, "ab"), "shared", "model_1_scores", "r1", now=NOW)
    assert not run_exists(spark, "shared.model_1_scores", "r2")
    env = dict(os.environ, PYTHONPATH=ROOT)
    out = subprocess.run([sys.executable, "-c", OTHER, place], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert score_job(spark, M1, feats(spark, "abc"), "shared", "model_1_scores", "r2", now=NOW).skipped
    assert run_rows(spark, "shared.model_1_scores", "r2") == 1


def test_string_features_reach_the_model(spark):
    f = spark.createDataFrame([("a", "3-x"), ("b", None)], "id string, level string")
    m = PythonModel("m", lambda pdf: pdf["level"].str[:1].astype("float64"), features=("level",))
    assert {r["id"]: r["m_prediction"] for r in score(f, m).collect()} == {"a": 3.0, "b": None}


def test_versions_are_ordered_as_numbers_and_rows_stay_whole(spark):
    reg = spark.createDataFrame([("m", "p", "9", "x"), ("m", "p", "10", "y"), ("m", "p", "old", "z")],
                                "name string, stage string, version string, owner string")
    assert latest_versions(reg).collect()[0].asDict() == {
        "name": "m", "stage": "p", "version": "10", "owner": "y", "model_uri": "models:/m/10"}


def test_aware_datetimes_are_stored_as_utc(spark):
    import datetime as dt

    at = dt.datetime(2026, 1, 1, 12, tzinfo=dt.timezone(dt.timedelta(hours=5)))
    assert spark.range(1).select(as_timestamp(at).alias("t")).first()["t"] == dt.datetime(2026, 1, 1, 7)
