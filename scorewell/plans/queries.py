"""Registered queries (one per operator of the inventory) and their oracles.

Each query is ``(spark, sf_dir) -> DataFrame`` over the driver's tables;
each oracle is DuckDB SQL over the same tables (pre-registered as views).
Computed columns carry the same alias on both sides.  Queries that write
use a fresh database under the shared checkpoint folder, so repeated calls
never see each other's tables.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewell.contracts import score_contract
from scorewell.functions.columns import as_timestamp, run_id_of, weighted_ensemble
from scorewell.functions.models import feature_columns
from scorewell.functions.stored import store_model, stored_model
from scorewell.operators.checks import (
    ValidationError,
    check_join,
    check_schema,
    check_scores,
    duplicate_keys,
    gate,
    input_counts,
    quality_metrics,
    report,
)
from scorewell.operators.drift import drift, histogram_contract, histograms
from scorewell.operators.merge import merge_scores, merge_unique, unmatched
from scorewell.operators.nested import check_nested_schema
from scorewell.operators.score import score, score_frame
from scorewell.plans import fixtures as fx
from scorewell.plans.jobs import (
    LEDGER_TABLE,
    ModelRun,
    PipelineConfig,
    merge_job,
    merged_check_frames,
    run_pipeline,
    score_job,
)
from scorewell.session import scratch_location, unique_name
from scorewell.sources.catalog import (
    ensure_database,
    read_run,
    run_rows,
    run_status,
    write_run,
    write_runs,
)
from scorewell.sources.evolution import read_evolved_features
from scorewell.sources.ledger import Ledger, latest_states
from scorewell.sources.registry import latest_versions, versions_at
from scorewell.sources.schedule import gaps, missing_runs

Query = Callable[[SparkSession, str], DataFrame]

MERGED_COLUMNS = ["id", "model_1_score", "model_2_score", "ensemble_score"]


# --- shared pieces -------------------------------------------------------------------------


def _features(spark, sf):
    return fx.features(spark, sf)


def _scores(spark, sf):
    """Both score sets."""
    s1 = score_frame(_features(spark, sf), fx.MODEL_1, now=fx.NOW)
    s2 = score_frame(fx.model_2_features(spark, sf), fx.MODEL_2, now=fx.NOW)
    return s1, s2


def _score_both(spark, sf, db):
    """Both scoring jobs, side by side as in the daily run; the rows that each read."""
    sides = [(fx.MODEL_1, _features(spark, sf)), (fx.MODEL_2, fx.model_2_features(spark, sf))]
    with ThreadPoolExecutor(max_workers=2) as pool:
        jobs = pool.map(
            lambda s: score_job(spark, s[0], s[1], db, f"{s[0].name}_scores", fx.RUN, now=fx.NOW), sides
        )
        return [j.details["rows_in"] for j in jobs]


def _merged(spark, sf, **kw):
    """The merge of both score sets as the merge job runs it: one shuffle,
    no join, so no key can multiply rows (a duplicate key fails the job)."""
    s1, s2 = _scores(spark, sf)
    return merge_unique(s1, s2, run_id=fx.RUN, now=fx.NOW, **kw)


def _scratch_db(spark, label) -> str:
    db = unique_name(f"sw_{label}")
    ensure_database(spark, db, location=scratch_location(spark, label))
    return db


def _ntz(df: DataFrame, *cols) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def _to_contract(frame: DataFrame) -> DataFrame:
    return frame.withColumn("scoring_timestamp", F.col("scoring_timestamp").cast("timestamp"))


# --- sources and projections -----------------------------------------------------------------


def q_feature_scan(spark, sf):
    return _features(spark, sf)


def q_feature_select(spark, sf):
    f = _features(spark, sf)
    return f.select(feature_columns(f))


def q_score_model_1(spark, sf):
    return score(_features(spark, sf), fx.MODEL_1).select("id", "model_1_prediction")


def q_score_model_2(spark, sf):
    return score(fx.model_2_features(spark, sf), fx.MODEL_2).select("id", "model_2_prediction")


def q_score_model_stored(spark, sf):
    """Model 2 from the bytes that a table has under its URI."""
    t = f"{_scratch_db(spark, 'models')}.models"
    uri = "models:/model_2/1"
    store_model(spark, t, uri, fx.model_2_json())
    store_model(spark, t, "models:/model_2/2", b"{}")
    model = stored_model(spark.table(t), uri, "model_2", features=fx.MODEL_2.features)
    return score(fx.model_2_features(spark, sf), model).select("id", "model_2_prediction")


def q_feature_scan_evolved(spark, sf):
    """Orders in two parts: the older has narrower types, no priority, and a column that went later."""
    return read_evolved_features(spark, fx.evolved_orders(spark, sf, scratch_location(spark, "evolved")), id_col="o_orderkey")


def q_score_model_mixed(spark, sf):
    """A model with a text input beside a numeric one."""
    o = fx.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("f_price"),
        F.col("o_orderpriority").alias("priority"),
    )
    return score(o, fx.MODEL_MIXED).select("id", "model_mixed_prediction")


def q_score_stamped(spark, sf):
    return score_frame(_features(spark, sf), fx.MODEL_1, run_id=fx.RUN, now=fx.NOW)


def q_run_ids(spark, sf):
    return fx.event_runs(spark, sf).groupBy("run_id").agg(F.count(F.lit(1)).alias("cnt"))


def q_latest_model_version(spark, sf):
    return latest_versions(fx.registry(spark, sf))


# --- merge --------------------------------------------------------------------------------


def q_merge_scores(spark, sf):
    return _merged(spark, sf)


def q_ensemble_mean(spark, sf):
    return _merged(spark, sf).select("id", "ensemble_score")


def q_ensemble_weighted(spark, sf):
    rule = weighted_ensemble([0.75, 0.25], digits=6)
    return _merged(spark, sf, ensemble=rule).select("id", "ensemble_score")


def q_merge_join(spark, sf):
    """The inner join itself: unique orders against many line items an order."""
    s1 = score_frame(_features(spark, sf), fx.MODEL_1, now=fx.NOW)
    s2 = score_frame(fx.line_scores(spark, sf), fx.MODEL_2, now=fx.NOW)
    return merge_scores(s1, s2, now=fx.NOW).select(*MERGED_COLUMNS)


def q_unmatched_ids(spark, sf):
    s1, s2 = _scores(spark, sf)
    return unmatched(s1, s2)


def q_duplicate_keys(spark, sf):
    scores = score_frame(fx.lineitem_features(spark, sf), fx.MODEL_1, now=fx.NOW)
    return duplicate_keys(scores)


def q_join_completeness(spark, sf):
    s1, s2 = _scores(spark, sf)
    return check_join(s1, s2)


def q_quality_metrics(spark, sf):
    return quality_metrics(_merged(spark, sf), ["model_1_score", "model_2_score", "ensemble_score"])


# --- catalog writes and reads -------------------------------------------------------------------


def q_write_run_first(spark, sf):
    db = _scratch_db(spark, "first")
    t = f"{db}.model_1_scores"
    frame = _to_contract(score_frame(_features(spark, sf), fx.MODEL_1, now=fx.NOW))
    write_run(frame, t, fx.RUN, contract=score_contract("model_1"))
    return _ntz(spark.table(t), "scoring_timestamp")


def _two_runs(spark, sf, db) -> tuple[str, list[int]]:
    """RUN by model 1 and RUN_B by its next version, over all orders; then RUN
    again: replaced, not doubled.  Returns the table and the counts of the writes."""
    t = f"{db}.model_1_scores"
    f, contract = _features(spark, sf), score_contract("model_1")
    frame = _to_contract(score_frame(f, fx.MODEL_1, now=fx.NOW))
    following = _to_contract(score_frame(f, fx.MODEL_1_NEXT, now=fx.NOW))
    return t, [
        write_run(frame, t, fx.RUN, contract=contract),
        write_run(following, t, fx.RUN_B, contract=contract),
        write_run(frame, t, fx.RUN, contract=contract),
    ]


def q_write_run_idempotent(spark, sf):
    t, (_, second, third) = _two_runs(spark, sf, _scratch_db(spark, "idem"))
    counted = F.when(F.col("run_id") == fx.RUN, F.lit(third)).otherwise(F.lit(second))
    return (
        spark.table(t).groupBy("run_id")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("model_1_prediction").isNull()).alias("null_predictions"),
            F.max("model_1_prediction").alias("largest"),
        )
        .withColumn("rows_of_the_write", counted.cast("bigint"))
    )


def q_read_run(spark, sf):
    t, _ = _two_runs(spark, sf, _scratch_db(spark, "read"))
    return read_run(spark, t, fx.RUN_B).select("id", "model_1_prediction", "run_id")


def q_run_rows(spark, sf):
    """Rows of a stored run, of one that doesn't exist, and of a missing table."""
    t, _ = _two_runs(spark, sf, _scratch_db(spark, "rows"))
    got = [("stored", run_rows(spark, t, fx.RUN)), ("other run", run_rows(spark, t, "none")),
           ("no table", run_rows(spark, f"{t}_none", fx.RUN))]
    return spark.createDataFrame(got, "what string, rows bigint")


def _yearly_runs(spark, sf, db) -> list[str]:
    """Two score tables, backfilled by year-runs (dynamic overwrite), side by side."""
    f = _features(spark, sf)
    ts_type = f.schema["timestamp"].dataType

    def backfill(side):
        frame, model = side
        runs = frame.withColumn(
            "run_id", run_id_of(F.date_trunc("year", F.col("timestamp")), ts_type)
        )
        scored = score_frame(runs, model, now=fx.NOW, carry_columns=("run_id",))
        table = f"{db}.{model.name}_scores"
        write_runs(_to_contract(scored), table, contract=score_contract(model.name))
        return table

    with ThreadPoolExecutor(max_workers=2) as pool:
        return list(pool.map(backfill, [(f, fx.MODEL_1), (fx.model_2_features(spark, sf), fx.MODEL_2)]))


def q_run_status(spark, sf):
    """Two backfilled tables and the rows of their runs, side by side."""
    t1, t2 = _yearly_runs(spark, sf, _scratch_db(spark, "status"))
    return run_status(spark, {"model_1_scores": t1, "model_2_scores": t2})


def q_score_drift(spark, sf):
    """Counts of the yearly runs' predictions, stored per run, and each run's drift from the one before."""
    db = _scratch_db(spark, "drift")
    counts = [histograms(spark.table(t), [g]) for t, g in zip(_yearly_runs(spark, sf, db), fx.DRIFT_GRIDS)]
    stored = f"{db}.score_histograms"
    write_runs(counts[0].unionByName(counts[1]), stored, contract=histogram_contract())
    return drift(spark.table(stored), fx.DRIFT_GRIDS, fx.DRIFT_MOST)


def q_version_as_of(spark, sf):
    return versions_at(fx.model_runs(spark, sf), fx.model_versions(spark, sf))


def q_run_gaps(spark, sf):
    """Days without a run, in a row, of each user's table, from the first day of all events to the last."""
    runs = fx.daily_runs(spark, sf)
    span = runs.agg(F.min("at").alias("first"), F.max("at").alias("last")).first()
    missing = missing_runs(runs, runs.select("table"), span["first"], span["last"])
    return gaps(missing)


def q_merge_input_counts(spark, sf):
    db = _scratch_db(spark, "counts")
    _score_both(spark, sf, db)
    return input_counts(*[read_run(spark, f"{db}.{m}_scores", fx.RUN) for m in ("model_1", "model_2")])


# --- jobs ----------------------------------------------------------------------------------


def q_score_job(spark, sf):
    db = _scratch_db(spark, "score")
    score_job(spark, fx.MODEL_1, _features(spark, sf), db, "model_1_scores", fx.RUN, now=fx.NOW)
    return read_run(spark, f"{db}.model_1_scores", fx.RUN).select(
        "id", "model_1_prediction", "model_name", "run_id"
    )


def q_skip_existing_run(spark, sf):
    """The second call, with another version of the model, leaves the run as it is."""
    db = _scratch_db(spark, "skip")
    f = _features(spark, sf)
    score_job(spark, fx.MODEL_1, f, db, "model_1_scores", fx.RUN, now=fx.NOW)
    second = score_job(spark, fx.MODEL_1_NEXT, f, db, "model_1_scores", fx.RUN, now=fx.NOW)
    return (
        spark.table(f"{db}.model_1_scores")
        .groupBy("run_id")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("model_1_prediction").alias("largest"))
        .withColumn("second_call_skipped", F.lit(bool(second.skipped)))
    )


def q_merge_job(spark, sf):
    db = _scratch_db(spark, "merge")
    _score_both(spark, sf, db)
    merge_job(spark, db, fx.RUN, now=fx.NOW)
    return read_run(spark, f"{db}.merged_model_scores", fx.RUN).select(*MERGED_COLUMNS, "run_id")


def _bucketed_runs(spark, sf, db):
    """RUN with as many buckets on both sides; RUN_B, by the models' next versions, with other ones on each."""
    f, f2 = _features(spark, sf), fx.model_2_features(spark, sf)
    for run, model_1, b1, b2 in ((fx.RUN, fx.MODEL_1, 8, 8), (fx.RUN_B, fx.MODEL_1_NEXT, 8, 12)):
        score_job(spark, model_1, f, db, "model_1_scores", run, now=fx.NOW, buckets=b1)
        score_job(spark, fx.MODEL_2, f2, db, "model_2_scores", run, now=fx.NOW, buckets=b2)


def q_merge_bucketed(spark, sf):
    """Runs stored in buckets by key: merged without a shuffle, or with one where their counts differ."""
    db = _scratch_db(spark, "buckets")
    _bucketed_runs(spark, sf, db)
    counts = {run: merge_job(spark, db, run, now=fx.NOW).details["join"] for run in (fx.RUN, fx.RUN_B)}
    only = F.when(F.col("run_id") == fx.RUN, counts[fx.RUN]["only_1"]).otherwise(counts[fx.RUN_B]["only_1"])
    merged = spark.table(f"{db}.merged_model_scores").select(*MERGED_COLUMNS, "run_id")
    return merged.withColumn("only_model_1", only.cast("bigint"))


def pipeline_config(spark, sf, db, model_2=fx.MODEL_2, versions=(None, None), **kw) -> PipelineConfig:
    return PipelineConfig(
        database=db,
        models=(ModelRun(fx.MODEL_1, _features(spark, sf), version=versions[0]),
                ModelRun(model_2, fx.model_2_features(spark, sf), version=versions[1])),
        **kw,
    )


def q_pipeline(spark, sf):
    db = _scratch_db(spark, "pipeline")
    result = run_pipeline(spark, pipeline_config(spark, sf, db), fx.RUN, now=fx.NOW)
    return result.merged.select(*MERGED_COLUMNS, "run_id")


def q_stored_report(spark, sf):
    """What the daily run stores in its report table, schema rows included."""
    db = _scratch_db(spark, "report")
    run_pipeline(spark, pipeline_config(spark, sf, db), fx.RUN, now=fx.NOW)
    return read_run(spark, f"{db}.validation_report", fx.RUN)


def _refusal(run) -> ValidationError:
    try:
        run()
    except ValidationError as e:
        return e
    raise AssertionError("the gate let it pass")


def q_refused_report(spark, sf):
    """What a run leaves whose models are refused (they may have no NULL prediction, and have some),
    and which of its rows the gate names."""
    db = _scratch_db(spark, "refused")
    stored = _refusal(lambda: run_pipeline(spark, pipeline_config(spark, sf, db, max_null_fraction=0.0), fx.RUN, now=fx.NOW))
    kept = read_run(spark, f"{db}.validation_report", fx.RUN)
    # The stored report refuses the run again by itself.
    named = [f"{f['scope']}/{f['check']}/{f['metric']}" for f in _refusal(lambda: gate(kept)).failures]
    assert len(stored.failures) == len(named)
    merged = spark.catalog.tableExists(f"{db}.merged_model_scores")
    row = F.concat_ws("/", "scope", "check", "metric")
    return kept.withColumns({"refused": row.isin(named), "merged": F.lit(merged)})


def q_run_ledger(spark, sf):
    """The latest state of each step after a run whose second model is refused, and after its repair."""
    db = _scratch_db(spark, "ledger")
    ledger = Ledger(spark, f"{db}.{LEDGER_TABLE}")

    def run(model_2, version):
        config = pipeline_config(spark, sf, db, model_2, ("7", version), ledger_table=LEDGER_TABLE)
        return run_pipeline(spark, config, fx.RUN, now=fx.NOW)

    _refusal(lambda: run(fx.MODEL_2_REFUSED, "1"))
    until = ledger.events(fx.RUN).agg(F.max("at").alias("at")).first()["at"]
    run(fx.MODEL_2, "2")
    every = ledger.events(fx.RUN)
    first = latest_states(every.where(F.col("at") <= as_timestamp(until))).withColumn("after", F.lit("refused"))
    both = first.unionByName(latest_states(every).withColumn("after", F.lit("repaired")))
    return both.select("after", "run_id", "step", "status", "rows", "version", "events")


def q_refused_inputs(spark, sf):
    """What the merge says to an empty side (no line item has a quantity of more than 50) and to a
    score set without the key, and what it leaves."""
    db = _scratch_db(spark, "inputs")
    none = fx.model_2_features(spark, sf, F.col("l_quantity") > 50)
    rows = [score_job(spark, m, f, db, f"{m.name}_scores", fx.RUN, now=fx.NOW).rows
            for m, f in ((fx.MODEL_1, _features(spark, sf)), (fx.MODEL_2, none))]
    s1, s2 = _scores(spark, sf)
    cases = {
        "empty side": lambda: merge_job(spark, db, fx.RUN, now=fx.NOW),
        "no key on side 2": lambda: merge_unique(s1, s2.withColumnRenamed("id", "order")),
        "no key on side 1": lambda: merge_scores(s1.drop("id"), s2),
    }
    got = []
    for what, run in cases.items():
        try:
            run()
            error = None
        except ValueError as e:
            error = str(e).replace(f"{db}.", "")
        got.append((what, error, *rows, run_rows(spark, f"{db}.merged_model_scores", fx.RUN)))
    return spark.createDataFrame(got, "what string, error string, rows_1 bigint, rows_2 bigint, merged_rows bigint")


# --- validation ----------------------------------------------------------------------------------


def _score_checks(spark, sf, s1, s2, rows_in=(None, None)):
    """V1 and V3 of both; features are counted unless the score jobs have (``rows_in``)."""
    f1, f2 = _features(spark, sf), fx.model_2_features(spark, sf)
    return [
        report(fx.RUN, "model_1", check_scores(f1, s1, "model_1", rows_in=rows_in[0])),
        report(fx.RUN, "model_2", check_scores(f2, s2, "model_2", rows_in=rows_in[1])),
    ]


def q_validate_scores(spark, sf):
    a, b = _score_checks(spark, sf, *_scores(spark, sf))
    return a.unionByName(b)


def q_validate_schema(spark, sf):
    """A text column that must cast: the values that don't are counted over the table."""
    contract = T.StructType([T.StructField("id", T.StringType()), T.StructField("level", T.ByteType()),
                             T.StructField("seen", T.LongType())])
    frame = fx.event_values(spark, sf).withColumn("extra", F.lit(1))
    return check_schema(frame, contract)


def q_validate_nested_schema(spark, sf):
    """Orders with their line items inside, against a contract for both."""
    return check_nested_schema(fx.nested_orders(spark, sf), fx.NESTED_CONTRACT)


def _strict_merge(spark, sf, label):
    """Both score sets and their merge, stored as the jobs store them, the counts of the merge, and the rows scored."""
    db = _scratch_db(spark, label)
    rows_in = _score_both(spark, sf, db)
    s1, s2 = (read_run(spark, f"{db}.{m}_scores", fx.RUN) for m in ("model_1", "model_2"))
    job = merge_job(spark, db, fx.RUN, now=fx.NOW)
    return s1, s2, read_run(spark, job.table, fx.RUN), job.details["join"], rows_in


def q_validate_merged(spark, sf):
    s1, s2, merged, counts, _ = _strict_merge(spark, sf, "vmerged")
    join_rows, merged_rows = merged_check_frames(s1, s2, merged, join_counts=counts)
    # V4 and V5 (the quality rows of V6 have their own query)
    return report(fx.RUN, "merged", join_rows, merged_rows.where(F.col("check") != "quality"))


def q_validation_report(spark, sf):
    s1, s2, merged, counts, rows_in = _strict_merge(spark, sf, "vreport")
    a, b = _score_checks(spark, sf, s1, s2, rows_in)
    return a.unionByName(b).unionByName(
        report(fx.RUN, "merged", *merged_check_frames(s1, s2, merged, join_counts=counts))
    )


QUERIES: dict[str, Query] = {
    "feature_scan": q_feature_scan,
    "feature_scan_evolved": q_feature_scan_evolved,
    "feature_select": q_feature_select,
    "score_model_1": q_score_model_1,
    "score_model_2": q_score_model_2,
    "score_model_mixed": q_score_model_mixed,
    "score_model_stored": q_score_model_stored,
    "score_stamped": q_score_stamped,
    "run_ids": q_run_ids,
    "latest_model_version": q_latest_model_version,
    "merge_scores": q_merge_scores,
    "merge_join": q_merge_join,
    "ensemble_mean": q_ensemble_mean,
    "ensemble_weighted": q_ensemble_weighted,
    "unmatched_ids": q_unmatched_ids,
    "join_completeness": q_join_completeness,
    "duplicate_keys": q_duplicate_keys,
    "quality_metrics": q_quality_metrics,
    "write_run_first": q_write_run_first,
    "write_run_idempotent": q_write_run_idempotent,
    "read_run": q_read_run,
    "run_rows": q_run_rows,
    "run_status": q_run_status,
    "score_drift": q_score_drift,
    "version_as_of": q_version_as_of,
    "run_gaps": q_run_gaps,
    "merge_input_counts": q_merge_input_counts,
    "score_job": q_score_job,
    "skip_existing_run": q_skip_existing_run,
    "merge_job": q_merge_job,
    "merge_bucketed": q_merge_bucketed,
    "daily_run": q_pipeline,
    "stored_report": q_stored_report,
    "refused_report": q_refused_report,
    "run_ledger": q_run_ledger,
    "refused_inputs": q_refused_inputs,
    "validate_scores": q_validate_scores,
    "validate_schema": q_validate_schema,
    "validate_nested_schema": q_validate_nested_schema,
    "validate_merged": q_validate_merged,
    "validation_report": q_validation_report,
}
