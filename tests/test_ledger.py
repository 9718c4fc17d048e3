"""The run ledger, what a refused run leaves, and ensemble rules of other kinds than the mean."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scorewell.functions.columns import mean_ensemble, weighted_ensemble, within_inputs
from scorewell.functions.models import LinearModel, PythonModel
from scorewell.operators.checks import ValidationError, check_ensemble, ensemble_check_rows
from scorewell.operators.merge import merge_unique
from scorewell.operators.score import score_frame
from scorewell.plans.jobs import LEDGER_TABLE, ModelRun, PipelineConfig, run_pipeline
from scorewell.sources.catalog import read_run, run_rows
from scorewell.sources.ledger import Event, Ledger, latest_states

M1 = LinearModel.of("model_1", {"x": 0.5})
M2 = LinearModel.of("model_2", {"x": 0.25})
NOW = "2026-01-01 12:00:00"


def feats(spark, n, nulls=0):
    rows = [(str(i), None if i < nulls else float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "id string, x double")


def config(spark, db, n=10, nulls=0, m2=M2, **kw):
    return PipelineConfig(database=db, models=(ModelRun(M1, feats(spark, 10), version="3"), ModelRun(m2, feats(spark, n, nulls), version="4")), **kw)


def report_rows(spark, db, run="r1"):
    rows = read_run(spark, f"{db}.validation_report", run).collect()
    return {(r["scope"], r["check"], r["metric"]): r["passed"] for r in rows}


def broken(_):
    raise RuntimeError("the model broke")


# --- what is stored before the gate raises ---------------------------------------------------


@pytest.mark.parametrize("parallel", [True, False])
def test_refused_model_leaves_its_report(spark, db, parallel):
    with pytest.raises(ValidationError, match="model_2/null_predictions/null_fraction"):
        run_pipeline(spark, config(spark, db, nulls=5, parallel=parallel), "r1", now=NOW)
    rows = report_rows(spark, db)
    assert rows["model_2", "null_predictions", "null_fraction"] is False
    assert rows["model_1", "row_count", "rows"] is True and not any(s == "merged" for s, *_ in rows)
    # Repaired without force: the refused model is scored again, the other isn't.
    done = run_pipeline(spark, config(spark, db), "r1", now=NOW)
    assert [j.skipped for j in done.jobs] == [True, False, False] and all(report_rows(spark, db).values())


def test_failed_model_leaves_the_other_ones_report(spark, db):
    bad = PythonModel("model_2", broken, features=("x",))
    with pytest.raises(Exception, match="the model broke"):
        run_pipeline(spark, config(spark, db, m2=bad, ledger_table=LEDGER_TABLE), "r1", now=NOW)
    rows = report_rows(spark, db)
    assert rows["model_2", "score_job", "error"] is False and rows["model_1", "row_count", "rows"] is True
    states = Ledger(spark, f"{db}.{LEDGER_TABLE}").states("r1")
    assert states["score model_2"]["status"] == "failed" and "Exception" in states["score model_2"]["detail"]
    assert states["run"]["status"] == "failed" and states["check model_1"]["status"] == "done" and "merge" not in states


def test_failed_merge_leaves_the_models_reports(spark, db):
    cfg = PipelineConfig(database=db, models=(ModelRun(M1, feats(spark, 4).union(feats(spark, 1))), ModelRun(M2, feats(spark, 4))), ledger_table=LEDGER_TABLE)
    with pytest.raises(ValueError, match="duplicate id"):
        run_pipeline(spark, cfg, "r1", now=NOW)
    rows = report_rows(spark, db)
    assert rows["merged", "merge_job", "error"] is False and rows["model_1", "row_count", "rows"] is True
    assert Ledger(spark, f"{db}.{LEDGER_TABLE}").states("r1")["merge"]["status"] == "failed"


def test_refused_merge_leaves_all_rows(spark, db):
    far = spark.createDataFrame([("z", 1.0)], "id string, x double")
    cfg = PipelineConfig(database=db, models=(ModelRun(M1, feats(spark, 3)), ModelRun(M2, far)))
    with pytest.raises(ValidationError, match="matched"):
        run_pipeline(spark, cfg, "r1", now=NOW)
    assert report_rows(spark, db)["merged", "join_completeness", "matched"] is False


# --- the ledger --------------------------------------------------------------------------------


def test_ledger_says_what_to_skip_and_what_to_do_again(spark, db):
    ledger = Ledger(spark, f"{db}.{LEDGER_TABLE}")
    assert ledger.states("r1") == {} and ledger.latest().count() == 0
    cfg = config(spark, db, ledger_table=LEDGER_TABLE)
    first = run_pipeline(spark, cfg, "r1", now=NOW)
    assert [j.skipped for j in first.jobs] == [False] * 3
    assert [j.skipped for j in run_pipeline(spark, cfg, "r1", now=NOW).jobs] == [True] * 3
    assert [j.skipped for j in run_pipeline(spark, cfg, "r1", now=NOW, force=True).jobs] == [False] * 3
    states = ledger.states("r1")
    assert {s: r["status"] for s, r in states.items()} == dict.fromkeys(
        ["run", "score model_1", "check model_1", "score model_2", "check model_2", "merge", "check merged"], "done")
    assert states["score model_2"]["version"] == "4" and states["merge"]["rows"] == 10
    status = ledger.status(["run", "merge", "never"]).collect()
    assert [tuple(r) for r in status] == [("r1", "done", "done", None)] and ledger.unfinished().count() == 0


def test_scores_stored_but_not_recorded_are_scored_again(spark, db):
    """The process ended between the commit of the run and its record: the ledger decides."""
    cfg = config(spark, db, ledger_table=LEDGER_TABLE)
    run_pipeline(spark, config(spark, db), "r1", now=NOW)  # without a ledger
    done = run_pipeline(spark, cfg, "r1", now=NOW)
    assert [j.skipped for j in done.jobs] == [False] * 3 and run_rows(spark, f"{db}.model_1_scores", "r1") == 10


def test_interrupted_run_goes_on_where_it_ended(spark, db):
    ledger, cfg = Ledger(spark, f"{db}.{LEDGER_TABLE}"), config(spark, db, ledger_table=LEDGER_TABLE)
    run_pipeline(spark, cfg, "r1", now=NOW)
    ledger.record("r1", [Event("run", "started"), Event("score model_2", "started")])  # and then it ended
    assert {(r["run_id"], r["step"], r["status"]) for r in ledger.unfinished().collect()} == {("r1", "run", "started"), ("r1", "score model_2", "started")}
    assert [j.skipped for j in run_pipeline(spark, cfg, "r1", now=NOW).jobs] == [True, False, False]


def test_latest_row_counts_and_rows_are_only_added(spark, db):
    ledger = Ledger(spark, f"{db}.ledger")
    for status in ("started", "failed", "started", "done"):
        ledger.record("r1", [Event("a", status), Event("b", "started", version=status)])
    ledger.record("r2", [Event("a", "refused", 5, "v", "why")])
    ledger.record("r2", [])
    got = {(r["run_id"], r["step"]): (r["status"], r["rows"], r["version"], r["detail"], r["events"]) for r in ledger.latest().collect()}
    assert got == {("r1", "a"): ("done", None, None, None, 4), ("r1", "b"): ("started", None, "done", None, 4), ("r2", "a"): ("refused", 5, "v", "why", 1)}
    assert ledger.events("r1").count() == 8 and ledger.events("none").count() == 0
    with pytest.raises(ValueError, match="unknown status"):
        Event("a", "fine")
    with pytest.raises(ValueError, match="invalid run_id"):
        ledger.record("a/b", [Event("a", "done")])


def test_ties_and_a_step_with_a_third_of_all_rows(spark):
    """Any order of the rows gives the same state; equal times go to the largest row."""
    at = dt.datetime(2026, 1, 1)
    rows = [("hot" if k % 3 == 0 else f"s{k}", "started", k, None, None, at + dt.timedelta(seconds=k), "r1") for k in range(300)]
    rows += [("tie", s, 1, None, None, at, "r1") for s in ("done", "started", "refused")]
    schema = "step string, status string, rows bigint, version string, detail string, at timestamp_ntz, run_id string"
    got = [{r["step"]: (r["rows"], r["status"], r["events"]) for r in latest_states(spark.createDataFrame(x, schema).repartition(n)).collect()}
           for x, n in ((rows, 2), (rows[::-1], 7))]
    assert got[0] == got[1] and got[0]["hot"] == (297, "started", 100) and got[0]["tie"] == (1, "started", 3)


# --- ensembles ----------------------------------------------------------------------------------


def filled(scores):
    """A hook that reads a missing score as the other one."""
    return (F.coalesce(scores[0], scores[1]) + F.coalesce(scores[1], scores[0])) / F.lit(2.0)


def summed(scores):
    """A hook whose result lies outside its inputs; missing scores are 0."""
    return F.coalesce(scores[0], F.lit(0.0)) + F.coalesce(scores[1], F.lit(0.0))


def checked(spark, ensemble, judged=None):
    s1 = score_frame(feats(spark, 6, nulls=2), M1, now=NOW)
    s2 = score_frame(spark.createDataFrame([(str(i), None if i % 2 else i + 3.0) for i in range(6)], "id string, x double"), M2, now=NOW)
    merged = merge_unique(s1, s2, ensemble=ensemble, now=NOW)
    one = check_ensemble(merged, ensemble=judged or ensemble)
    return one.first().asDict(), all(r["passed"] for r in ensemble_check_rows(one).collect())


@pytest.mark.parametrize("rule, out_of_range", [(mean_ensemble, 0), (filled, None), (within_inputs(lambda s: filled(s)), 0), (summed, None),
                                                (weighted_ensemble([0.75, 0.25]), 0), (weighted_ensemble([2, 1]), None)])
def test_a_rule_of_any_kind_holds(spark, rule, out_of_range):
    got, passed = checked(spark, rule)
    assert got == {"rows": 6, "null_mismatch": 0, "rule_mismatch": 0, "out_of_range": out_of_range} and passed


def test_departures_from_the_rule_are_counted(spark):
    got, passed = checked(spark, summed, judged=filled)
    assert got["rule_mismatch"] == 2 and not passed  # the rows with both scores
    assert got["null_mismatch"] == 1  # the row without any: 0 and NULL
    got, passed = checked(spark, summed, judged=mean_ensemble)
    assert got["null_mismatch"] == 4 and got["out_of_range"] > 0 and not passed


def test_pipeline_takes_a_summing_hook(spark, db):
    res = run_pipeline(spark, config(spark, db, ensemble=summed), "r1", now=NOW)
    assert res.merged.count() == 10 and all(report_rows(spark, db).values())
