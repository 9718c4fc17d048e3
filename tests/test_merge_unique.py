"""The one-shuffle strict merge equals the join merge and its counts equal
check_join; the pipeline's report passes on the fixture."""

import pytest
from pyspark.sql import functions as F

from scorewell.functions.models import LinearModel
from scorewell.operators.checks import check_join
from scorewell.operators.merge import MergeMetrics, merge_scores, merge_unique
from scorewell.operators.score import score_frame
from scorewell.plans import fixtures as fx
from scorewell.plans.jobs import ModelRun, PipelineConfig, run_pipeline
from tests.conftest import SF_SMALL

M1 = LinearModel.of("model_1", {"x": 0.5})
M2 = LinearModel.of("model_2", {"x": 0.25}, link="logistic")
NOW = "2026-01-01 12:00:00"


def test_same_rows_and_counts_as_join_on_fixture(spark):
    f = fx.features(spark, SF_SMALL)
    s1 = score_frame(f, fx.MODEL_1, now=fx.NOW)
    s2 = score_frame(fx.model_2_features(spark, SF_SMALL), fx.MODEL_2, now=fx.NOW)
    mm = MergeMetrics()
    u = merge_unique(s1, s2, run_id=fx.RUN, now=fx.NOW, metrics=mm)
    j = merge_scores(s1, s2, run_id=fx.RUN, now=fx.NOW)
    assert u.columns == j.columns
    assert sorted(map(tuple, u.collect())) == sorted(map(tuple, j.collect()))
    assert mm.get() == check_join(s1, s2).first().asDict()


def test_null_keys_counted_like_check_join(spark):
    a = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 3.0), ("b", 1.0)],
                              "id string, x double")
    b = spark.createDataFrame([("a", 1.0), (None, 2.0), ("c", 1.0)], "id string, x double")
    s1, s2 = score_frame(a, M1, now=NOW), score_frame(b, M2, now=NOW)
    mm = MergeMetrics()
    rows = merge_unique(s1, s2, now=NOW, metrics=mm).collect()
    assert [r["id"] for r in rows] == ["a"]
    assert mm.get() == check_join(s1, s2).first().asDict()


def test_duplicate_key_fails_while_running(spark):
    a = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "id string, x double")
    with pytest.raises(Exception, match="duplicate id in merge inputs: a"):
        merge_unique(score_frame(a, M1, now=NOW), score_frame(a, M2, now=NOW)).collect()


def test_pipeline_report_passes_and_is_stored(spark, db):
    f = fx.features(spark, SF_SMALL)
    cfg = PipelineConfig(database=db, models=(ModelRun(fx.MODEL_1, f),
                                              ModelRun(fx.MODEL_2, fx.model_2_features(spark, SF_SMALL))))
    res = run_pipeline(spark, cfg, fx.RUN, now=fx.NOW)
    stored = spark.table(f"{db}.validation_report").where(F.col("run_id") == fx.RUN)
    assert stored.count() == res.report.count() > 20
    assert stored.where(~F.col("passed")).count() == 0
    merged_rows = stored.where("metric = 'merged_rows'").first()
    assert merged_rows["value"] == res.merged.count() == merged_rows["threshold"]
    # a second run of the same id is skipped everywhere and changes nothing
    again = run_pipeline(spark, cfg, fx.RUN, now=fx.NOW)
    assert all(j.skipped for j in again.jobs)
    assert again.merged.count() == res.merged.count()
