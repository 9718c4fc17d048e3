"""Edge rows: NULL / NaN features, NULL and duplicate ids, one-sided ids,
empty and stale runs, missing tables and columns, DECIMAL input, bad run ids,
unknown registry entries."""

import decimal
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewell.contracts import score_contract
from scorewell.functions.models import LinearModel, PythonModel
from scorewell.operators.checks import check_join, check_scores
from scorewell.operators.merge import merge_scores, unmatched
from scorewell.operators.score import score, score_frame
from scorewell.plans.jobs import merge_job, score_job
from scorewell.sources.catalog import read_run, run_exists, write_run
from scorewell.sources.registry import resolve

LIN = LinearModel.of("model_1", {"x": 0.5, "y": 0.25})
LOGIT = LinearModel.of("model_2", {"x": 0.125, "y": -0.25}, link="logistic")
NOW = "2026-01-01 12:00:00"

FEAT_SCHEMA = "id string, x double, y double"


def feats(spark, rows):
    return spark.createDataFrame(rows, FEAT_SCHEMA)


def preds(df, name):
    return {r["id"]: r[f"{name}_prediction"] for r in df.collect()}


def test_null_feature_gives_null_prediction_and_null_ensemble(spark):
    f = feats(spark, [("a", 1.0, 1.0), ("b", None, 2.0)])
    s1 = score_frame(f, LIN, now=NOW)
    s2 = score_frame(f, LOGIT.as_python(), now=NOW)
    assert preds(s1, "model_1")["b"] is None
    assert preds(s2, "model_2")["b"] is None
    merged = {r["id"]: r["ensemble_score"] for r in merge_scores(s1, s2, now=NOW).collect()}
    assert merged["b"] is None and merged["a"] is not None


@pytest.mark.parametrize("model", [LIN, LIN.as_python(), LOGIT, LOGIT.as_python()])
def test_nan_feature_gives_null_on_every_path(spark, model):
    f = feats(spark, [("c", float("nan"), 1.0), ("d", 1.0, 1.0)])
    p = preds(score(f, model), model.name)
    assert p["c"] is None
    assert p["d"] is not None and not math.isnan(p["d"])


def test_udf_path_equals_native_path(spark):
    rows = [(str(i), i * 0.37 - 3.0, (i % 7) * 1.5) for i in range(200)] + [("n", None, 1.0)]
    f = feats(spark, rows)
    for model in (LIN, LOGIT):
        native = preds(score(f, model), model.name)
        udf = preds(score(f, model.as_python()), model.name)
        assert native.keys() == udf.keys()
        for k in native:
            if native[k] is None:
                assert udf[k] is None
            else:
                assert udf[k] == pytest.approx(native[k], rel=1e-15, abs=1e-300)


def test_null_id_is_scored_dropped_by_join_and_reported(spark):
    f = feats(spark, [("a", 1.0, 1.0), (None, 3.0, 1.0)])
    s1, s2 = score_frame(f, LIN, now=NOW), score_frame(f, LOGIT, now=NOW)
    assert s1.count() == 2
    assert merge_scores(s1, s2, now=NOW).count() == 1
    um = unmatched(s1, s2).collect()
    assert sorted((r["id"], r["missing_from"]) for r in um if r["id"] is None) == [
        (None, "model_1"), (None, "model_2")]
    checks = {r["check"]: r for r in check_scores(f, s1, "model_1").collect()}
    assert checks["null_ids"]["value"] == 1.0 and checks["null_ids"]["passed"] is False
    jc = check_join(s1, s2).first()
    assert (jc["matched"], jc["only_1"], jc["only_2"]) == (1, 1, 1)


def test_duplicate_ids_multiply_and_are_reported(spark):
    f = feats(spark, [("a", 1.0, 1.0), ("a", 2.0, 1.0), ("b", 1.0, 1.0)])
    s1, s2 = score_frame(f, LIN, now=NOW), score_frame(f, LOGIT, now=NOW)
    merged = merge_scores(s1, s2, now=NOW)
    assert merged.where("id = 'a'").count() == 4
    jc = check_join(s1, s2).first()
    assert jc["dup_ids"] == 1 and jc["expected_rows"] == 5 and merged.count() == 5


def test_strict_merge_refuses_duplicates(spark, db):
    f = feats(spark, [("a", 1.0, 1.0), ("a", 2.0, 1.0)])
    score_job(spark, LIN, f, db, "model_1_scores", "r1", now=NOW)
    score_job(spark, LOGIT, f, db, "model_2_scores", "r1", now=NOW)
    with pytest.raises(ValueError, match="duplicate"):
        merge_job(spark, db, "r1", now=NOW)
    assert not run_exists(spark, f"{db}.merged_model_scores", "r1")
    res = merge_job(spark, db, "r1", now=NOW, strict=False)
    assert res.rows == 4


def test_one_sided_ids(spark):
    f1 = feats(spark, [("a", 1.0, 1.0), ("only1", 1.0, 1.0)])
    f2 = feats(spark, [("a", 1.0, 1.0), ("only2", 1.0, 1.0)])
    s1, s2 = score_frame(f1, LIN, now=NOW), score_frame(f2, LOGIT, now=NOW)
    assert [r["id"] for r in merge_scores(s1, s2, now=NOW).collect()] == ["a"]
    got = sorted((r["id"], r["missing_from"]) for r in unmatched(s1, s2).collect())
    assert got == [("only1", "model_2"), ("only2", "model_1")]


def test_empty_run_is_not_done_and_merge_names_table_and_run(spark, db):
    empty = feats(spark, [])
    res = score_job(spark, LIN, empty, db, "model_1_scores", "r1", now=NOW)
    assert res.rows == 0 and not run_exists(spark, f"{db}.model_1_scores", "r1")
    score_job(spark, LOGIT, feats(spark, [("a", 1.0, 1.0)]), db, "model_2_scores", "r1", now=NOW)
    with pytest.raises(ValueError, match=rf"{db}\.model_1_scores, run r1, has no rows"):
        merge_job(spark, db, "r1", now=NOW)


def test_stale_run_rewritten_empty_leaves_others(spark, db):
    t = f"{db}.model_1_scores"
    f = feats(spark, [("a", 1.0, 1.0), ("b", 1.0, 1.0), ("c", 1.0, 1.0)])
    frame = score_frame(f, LIN, now=NOW).withColumn(
        "scoring_timestamp", F.col("scoring_timestamp").cast("timestamp"))
    write_run(frame, t, "r1", contract=score_contract("model_1"))
    write_run(frame, t, "r2", contract=score_contract("model_1"))
    assert write_run(frame.limit(0), t, "r1") == 0
    assert read_run(spark, t, "r1").count() == 0
    assert read_run(spark, t, "r2").count() == 3


def test_missing_table_is_not_done(spark, db):
    assert run_exists(spark, f"{db}.nope", "r1") is False


def test_missing_key_column_in_merge(spark):
    f = feats(spark, [("a", 1.0, 1.0)])
    s1 = score_frame(f, LIN, now=NOW).withColumnRenamed("id", "key")
    s2 = score_frame(f, LOGIT, now=NOW)
    with pytest.raises(ValueError, match="no key column 'id'"):
        merge_scores(s1, s2)


def test_missing_contract_column_is_an_error(spark, db):
    f = feats(spark, [("a", 1.0, 1.0)])
    frame = score_frame(f, LIN, now=NOW).drop("model_name")
    with pytest.raises(ValueError, match="missing \\['model_name'\\]"):
        write_run(frame, f"{db}.model_1_scores", "r1", contract=score_contract("model_1"))


def test_extra_column_is_an_error(spark, db):
    f = feats(spark, [("a", 1.0, 1.0)])
    frame = score_frame(f, LIN, now=NOW, carry_columns=("x",))
    with pytest.raises(ValueError, match="extra \\['x'\\]"):
        write_run(frame, f"{db}.model_1_scores", "r1", contract=score_contract("model_1"))


def test_decimal_feature_is_cast_before_the_udf(spark):
    schema = T.StructType([T.StructField("id", T.StringType()),
                           T.StructField("x", T.DecimalType(12, 2)),
                           T.StructField("y", T.DecimalType(12, 2))])
    f = spark.createDataFrame([("a", decimal.Decimal("2.50"), decimal.Decimal("4.00"))], schema)
    assert preds(score(f, LIN.as_python()), "model_1")["a"] == 2.25
    assert preds(score(f, LIN), "model_1")["a"] == 2.25


def test_python_model_with_loader_and_default_features(spark):
    f = feats(spark, [("a", 1.0, 2.0)]).withColumn("label", F.lit(1))
    model = PythonModel("m", lambda w, pdf: pdf["x"] * w[0] + pdf["y"] * w[1],
                        loader=lambda: (10.0, 100.0))
    assert preds(score(f, model), "m")["a"] == 210.0


@pytest.mark.parametrize("bad", ["r'1", "r 1", "", "r1;drop", "a\\b", "r1\n"])
def test_bad_run_id_refused(spark, db, bad):
    f = feats(spark, [("a", 1.0, 1.0)])
    with pytest.raises(ValueError, match="invalid run_id"):
        score_job(spark, LIN, f, db, "model_1_scores", bad, now=NOW)


def test_unknown_model_or_stage(spark):
    reg = spark.createDataFrame([("m", "Production", 1), ("m", "Production", 3)],
                                "name string, stage string, version int")
    assert resolve(reg, "m", "Production") == ("models:/m/3", 3)
    with pytest.raises(ValueError, match="no version of 'm' at stage 'Staging'"):
        resolve(reg, "m", "Staging")
    with pytest.raises(ValueError, match="no version of 'x' at stage 'Production'"):
        resolve(reg, "x", "Production")


def test_lineitem_duplicates_reported_and_strict_merge_refuses(spark, db):
    from scorewell.operators.checks import duplicate_keys
    from scorewell.plans import fixtures as fx
    from tests.conftest import SF_SMALL

    f = fx.lineitem_features(spark, SF_SMALL)
    dups = duplicate_keys(score_frame(f, fx.MODEL_1, now=NOW))
    n_rows, n_keys = f.count(), f.select("id").distinct().count()
    assert dups.agg(F.sum(F.col("copies") - 1)).first()[0] == n_rows - n_keys > 0
    score_job(spark, fx.MODEL_1, f, db, "model_1_scores", "r1", now=NOW)
    score_job(spark, fx.MODEL_2, f, db, "model_2_scores", "r1", now=NOW)
    with pytest.raises(ValueError, match="duplicate id"):
        merge_job(spark, db, "r1", now=NOW)
    assert not run_exists(spark, f"{db}.merged_model_scores", "r1")
