"""Backfill writes, run status, registry and multi-model scoring."""

from pyspark.sql import functions as F

from scorewell.contracts import score_contract
from scorewell.functions.models import LinearModel
from scorewell.operators.score import score, score_frame, score_many
from scorewell.sources.catalog import (
    read_run,
    run_counts,
    run_rows,
    run_status,
    write_run,
    write_runs,
)
from scorewell.sources.registry import latest_versions

M1 = LinearModel.of("model_1", {"x": 0.5})
M2 = LinearModel.of("model_2", {"x": 0.25}, link="logistic")
NOW = "2026-01-01 12:00:00"


def scored(spark, rows, model=M1):
    f = spark.createDataFrame(rows, "id string, x double, run_id string")
    out = score_frame(f, model, now=NOW, carry_columns=("run_id",))
    return out.withColumn("scoring_timestamp", F.col("scoring_timestamp").cast("timestamp"))


def test_backfill_replaces_only_runs_present(spark, db):
    t = f"{db}.model_1_scores"
    first = scored(spark, [("a", 1.0, "r1"), ("b", 1.0, "r1"), ("c", 1.0, "r2"), ("d", 1.0, "r3")])
    assert write_runs(first, t, contract=score_contract("model_1")) == 4
    again = scored(spark, [("x", 1.0, "r2"), ("y", 1.0, "r2"), ("z", 1.0, "r4")])
    assert write_runs(again, t) == 3
    got = {r["run_id"]: r["rows"] for r in run_counts(spark, {"t": t}).collect()}
    assert got == {"r1": 2, "r2": 2, "r3": 1, "r4": 1}
    assert sorted(r["id"] for r in read_run(spark, t, "r2").collect()) == ["x", "y"]


def test_run_status_pivot_leaves_absent_runs_null(spark, db):
    t1, t2 = f"{db}.model_1_scores", f"{db}.model_2_scores"
    write_runs(scored(spark, [("a", 1.0, "r1"), ("b", 1.0, "r2")]), t1,
               contract=score_contract("model_1"))
    write_runs(scored(spark, [("a", 1.0, "r1")], M2), t2, contract=score_contract("model_2"))
    rows = {r["run_id"]: (r["m1"], r["m2"]) for r in
            run_status(spark, {"m1": t1, "m2": t2}).collect()}
    assert rows == {"r1": (1, 1), "r2": (1, None)}
    assert run_rows(spark, t2, "r2") == 0 and run_rows(spark, f"{db}.missing", "r1") == 0


def test_single_run_write_then_backfill_share_one_table(spark, db):
    t = f"{db}.model_1_scores"
    frame = scored(spark, [("a", 1.0, "r1")]).drop("run_id")
    write_run(frame, t, "r0", contract=score_contract("model_1"))
    write_runs(scored(spark, [("b", 1.0, "r1")]), t)
    assert {r["run_id"] for r in spark.table(t).select("run_id").distinct().collect()} == {"r0", "r1"}


def test_score_many_equals_single_model_scoring(spark):
    f = spark.createDataFrame([(str(i), i * 1.5 - 4.0) for i in range(50)] + [("n", None)],
                              "id string, x double")
    both = {r["id"]: (r["model_1_prediction"], r["model_2_prediction"])
            for r in score_many(f, [M1, M2.as_python()]).collect()}
    one = {r["id"]: r["model_1_prediction"] for r in score(f, M1).collect()}
    two = {r["id"]: r["model_2_prediction"] for r in score(f, M2.as_python()).collect()}
    assert both == {k: (one[k], two[k]) for k in one}


def test_latest_versions_and_uri(spark):
    reg = spark.createDataFrame(
        [("m", "Production", 1), ("m", "Production", 7), ("m", "Staging", 9), ("n", "Production", 2)],
        "name string, stage string, version int")
    got = {(r["name"], r["stage"]): (r["version"], r["model_uri"])
           for r in latest_versions(reg).collect()}
    assert got == {("m", "Production"): (7, "models:/m/7"), ("m", "Staging"): (9, "models:/m/9"),
                   ("n", "Production"): (2, "models:/n/2")}
