"""Physical-plan properties the design relies on."""

from pyspark.sql import functions as F

from scorewell.contracts import score_contract
from scorewell.operators.checks import check_join
from scorewell.operators.merge import merge_scores, unmatched
from scorewell.operators.score import score, score_frame
from scorewell.plans import fixtures as fx
from scorewell.sources.catalog import read_run, write_run
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_native_model_has_no_python_node_and_is_codegen(spark):
    df = score(fx.features(spark, SF_SMALL), fx.MODEL_1).select("id", "model_1_prediction")
    p = plan(df)
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p
    assert "WholeStageCodegen" in p or "*(" in p


def test_udf_model_is_one_arrow_node(spark):
    f = fx.model_2_features(spark, SF_SMALL)
    p = plan(score(f, fx.MODEL_2).select("id", "model_2_prediction"))
    assert p.count("ArrowEvalPython") == 1
    assert "BatchEvalPython" not in p


def test_scan_reads_only_needed_columns(spark):
    df = score(fx.features(spark, SF_SMALL), fx.MODEL_1).select("id", "model_1_prediction")
    p = plan(df)
    # o_custkey and o_orderstatus are not needed by model 1's columns
    read_schema = p.split("ReadSchema: ")[1].split("\n")[0]
    assert "o_custkey" not in read_schema and "o_orderstatus" not in read_schema


def test_filter_before_scoring_is_pushed_to_parquet(spark):
    f = fx.table(spark, SF_SMALL, "orders").where(F.col("o_totalprice") > 1000.0)
    f = f.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("f_price"),
                 F.lit(1.0).alias("f_priority"), F.lit(1.0).alias("f_month"))
    p = plan(score(f, fx.MODEL_2))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in p


def test_read_run_prunes_partitions(spark, db):
    t = f"{db}.model_1_scores"
    frame = score_frame(fx.features(spark, SF_SMALL), fx.MODEL_1, now=fx.NOW).withColumn(
        "scoring_timestamp", F.col("scoring_timestamp").cast("timestamp"))
    write_run(frame, t, "r1", contract=score_contract("model_1"))
    write_run(frame, t, "r2", contract=score_contract("model_1"))
    p = plan(read_run(spark, t, "r2"))
    assert "PartitionFilters: [isnotnull(run_id" in p and "(run_id#" in p and "= r2)" in p


def test_write_count_comes_from_the_write(spark, db):
    frame = score_frame(fx.features(spark, SF_SMALL), fx.MODEL_1, now=fx.NOW).withColumn(
        "scoring_timestamp", F.col("scoring_timestamp").cast("timestamp"))
    n = write_run(frame, f"{db}.model_1_scores", "r1", contract=score_contract("model_1"))
    assert n == fx.features(spark, SF_SMALL).count()


def test_merge_shuffles_only_thin_columns_and_drops_null_keys_early(spark):
    f = fx.features(spark, SF_SMALL)
    s1 = score_frame(f, fx.MODEL_1, now=fx.NOW)
    s2 = score_frame(fx.model_2_features(spark, SF_SMALL), fx.MODEL_2, now=fx.NOW)
    merged = merge_scores(s1, s2, now=fx.NOW)
    optimized = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(" in optimized
    # Features that are no model input never reach the join.
    assert "o_custkey" not in plan(merged)


def test_join_check_has_one_aggregation_shuffle_and_no_join(spark):
    f = fx.features(spark, SF_SMALL)
    s1 = score_frame(f, fx.MODEL_1, now=fx.NOW)
    s2 = score_frame(f, fx.MODEL_1, now=fx.NOW)
    p = check_join(s1, s2)._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in p
    assert "HashAggregate" in p


def test_unmatched_is_one_shuffle_of_two_scans_and_no_join(spark):
    f = fx.features(spark, SF_SMALL)
    s1 = score_frame(f, fx.MODEL_1, now=fx.NOW)
    s2 = score_frame(f, fx.MODEL_1, now=fx.NOW)
    p = plan(unmatched(s1, s2))
    assert "Join" not in p
    assert p.count("Exchange hashpartitioning") == 1 and p.count("FileScan parquet") == 2


def test_counting_the_rows_in_leaves_the_scan_pruned(spark):
    """The observed features of a scoring write read the model's columns only."""
    from pyspark.sql import Observation

    f = fx.table(spark, SF_SMALL, "orders").withColumnsRenamed({"o_orderkey": "id", "o_totalprice": "x"})
    from scorewell.functions.models import LinearModel
    from scorewell.plans.jobs import counted_features

    m = LinearModel.of("model_1", {"x": 0.5})
    p = plan(score(counted_features(f, m, Observation()), m).select("id", "model_1_prediction"))
    read_schema = p.split("ReadSchema: ")[1].split("\n")[0]
    assert "o_custkey" not in read_schema and "o_totalprice" in read_schema


def test_registered_merges_have_no_join(spark):
    """The checked merge queries pair no rows: one aggregation shuffle."""
    from scorewell.plans.queries import QUERIES

    for name in ("merge_scores", "ensemble_mean", "ensemble_weighted", "quality_metrics"):
        p = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
        assert "Join" not in p, name
        assert "HashAggregate" in p, name
