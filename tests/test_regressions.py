"""One test per write/merge defect of the job as first written: each pins
the intended behaviour."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from scorewell.contracts import score_contract
from scorewell.functions.models import LinearModel
from scorewell.operators.merge import merge_scores
from scorewell.operators.score import score_frame, stamp, score
from scorewell.plans.jobs import merge_job, score_job
from scorewell.sources.catalog import read_run, run_exists, table_exists, write_run

M1 = LinearModel.of("model_1", {"x": 0.5})
M2 = LinearModel.of("model_2", {"x": 0.25})
NOW = "2026-01-01 12:00:00"


def feats(spark, n, offset=0):
    return spark.createDataFrame([(str(i + offset), float(i)) for i in range(n)], "id string, x double")


def test_mean_ensemble_is_plain_mean(spark):
    f = feats(spark, 3)
    m = merge_scores(score_frame(f, M1, now=NOW), score_frame(f, M2, now=NOW), now=NOW)
    for r in m.collect():
        assert r["ensemble_score"] == (r["model_1_score"] + r["model_2_score"]) / 2.0


def test_table_exists_sees_existing_table(spark, db):
    score_job(spark, M1, feats(spark, 2), db, "model_1_scores", "r1", now=NOW)
    assert table_exists(spark, f"{db}.model_1_scores")
    assert run_exists(spark, f"{db}.model_1_scores", "r1")


def test_later_runs_do_not_erase_earlier_runs(spark, db):
    for i, run in enumerate(["r1", "r2", "r3"]):
        score_job(spark, M1, feats(spark, 2 + i), db, "model_1_scores", run, now=NOW)
    got = {r["run_id"]: r["count"] for r in
           spark.table(f"{db}.model_1_scores").groupBy("run_id").count().collect()}
    assert got == {"r1": 2, "r2": 3, "r3": 4}


def test_rerun_of_existing_run_replaces_it(spark, db):
    t = f"{db}.model_1_scores"
    score_job(spark, M1, feats(spark, 5), db, "model_1_scores", "r1", now=NOW)
    score_job(spark, M1, feats(spark, 2), db, "model_1_scores", "r2", now=NOW)
    res = score_job(spark, M1, feats(spark, 3, offset=100), db, "model_1_scores", "r1",
                    now=NOW, force=True)
    assert res.rows == 3 and not res.skipped
    assert sorted(r["id"] for r in read_run(spark, t, "r1").collect()) == ["100", "101", "102"]
    assert read_run(spark, t, "r2").count() == 2


def test_done_run_is_skipped(spark, db):
    score_job(spark, M1, feats(spark, 5), db, "model_1_scores", "r1", now=NOW)
    res = score_job(spark, M1, feats(spark, 1), db, "model_1_scores", "r1", now=NOW)
    assert res.skipped and read_run(spark, f"{db}.model_1_scores", "r1").count() == 5


def test_wide_frame_is_refused_narrow_frame_written(spark, db):
    wide = stamp(score(feats(spark, 2), M1), "model_1", None, NOW)
    with pytest.raises(ValueError, match="extra"):
        write_run(wide, f"{db}.model_1_scores", "r1", contract=score_contract("model_1"))


def test_column_order_does_not_matter(spark, db):
    frame = score_frame(feats(spark, 2), M1, now=NOW).withColumn(
        "scoring_timestamp", F.col("scoring_timestamp").cast("timestamp"))
    reordered = frame.select("model_name", "scoring_timestamp", "model_1_prediction", "id")
    write_run(reordered, f"{db}.model_1_scores", "r1", contract=score_contract("model_1"))
    row = read_run(spark, f"{db}.model_1_scores", "r1").orderBy("id").first()
    assert row["model_name"] == "model_1" and row["model_1_prediction"] == 0.0


def test_model_names_are_parameters_of_the_merge(spark, db):
    a = LinearModel.of("alpha", {"x": 1.0})
    b = LinearModel.of("beta", {"x": 2.0})
    f = feats(spark, 3)
    score_job(spark, a, f, db, "alpha_scores", "r1", now=NOW)
    score_job(spark, b, f, db, "beta_scores", "r1", now=NOW)
    res = merge_job(spark, db, "r1", "alpha", "beta", now=NOW)
    m = spark.table(res.table)
    assert {"alpha_score", "beta_score", "alpha_timestamp", "beta_timestamp"} <= set(m.columns)
    assert m.count() == 3


def test_exists_check_errors_propagate(spark):
    with pytest.raises((ValueError, AnalysisException)):
        run_exists(spark, "a.b.c", "r1")


def test_run_id_never_pasted_into_sql(spark, db):
    with pytest.raises(ValueError, match="invalid run_id"):
        read_run(spark, f"{db}.model_1_scores", "x' OR '1'='1")
