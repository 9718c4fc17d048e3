"""The non-strict merge job (the reference's join): its join-completeness
counts come from one aggregation before the join, so the size of the join
is known before it runs, and empty inputs still fail naming table and run."""

import pytest

from scorewell.functions.models import LinearModel
from scorewell.plans.jobs import merge_job, score_job

LIN = LinearModel.of("model_1", {"x": 0.5})
LOGIT = LinearModel.of("model_2", {"x": 0.25}, link="logistic")
NOW = "2026-01-01 12:00:00"


def feats(spark, rows):
    return spark.createDataFrame(rows, "id string, x double")


def test_non_strict_counts_before_the_join(spark, db):
    score_job(spark, LIN, feats(spark, [("a", 1.0), ("a", 2.0), ("b", 1.0), ("c", 1.0)]),
              db, "model_1_scores", "r1", now=NOW)
    score_job(spark, LOGIT, feats(spark, [("a", 1.0), ("a", 3.0), ("b", 2.0), ("d", 1.0)]),
              db, "model_2_scores", "r1", now=NOW)
    res = merge_job(spark, db, "r1", now=NOW, strict=False)
    jc = res.details["join"]
    assert jc == {"n1": 4, "n2": 4, "matched": 2, "only_1": 1, "only_2": 1, "dup_ids": 1,
                  "expected_rows": 5}
    assert res.rows == jc["expected_rows"] == 5


def test_non_strict_empty_input_names_table_and_run(spark, db):
    score_job(spark, LIN, feats(spark, []), db, "model_1_scores", "r1", now=NOW)
    score_job(spark, LOGIT, feats(spark, [("a", 1.0)]), db, "model_2_scores", "r1", now=NOW)
    with pytest.raises(ValueError, match=rf"{db}\.model_1_scores, run r1, has no rows"):
        merge_job(spark, db, "r1", now=NOW, strict=False)
