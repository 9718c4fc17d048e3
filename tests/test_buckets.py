"""Runs stored in buckets by key: the merge reads them without a shuffle."""

import os
import re

import pytest
from pyspark.sql import functions as F

from scorewell.contracts import score_contract
from scorewell.functions.models import LinearModel
from scorewell.operators.checks import check_join
from scorewell.operators.merge import merge_unique
from scorewell.operators.score import score_frame
from scorewell.plans import fixtures as fx
from scorewell.plans.jobs import merge_job, score_job
from scorewell.sources.catalog import read_run, read_run_by_key, run_buckets, run_exists, run_folder, run_status, write_run
from tests.conftest import SF_SMALL

M1 = LinearModel.of("model_1", {"x": 0.5})
M2 = LinearModel.of("model_2", {"x": 0.25})
NOW = "2026-01-01 12:00:00"


def feats(spark, keys, parts=3):
    return spark.createDataFrame([(k, float(n)) for n, k in enumerate(keys)], "id string, x double").repartition(parts)


def both(spark, db, b1, b2, keys_1="abcdef", keys_2="bcdefg", run="r1"):
    score_job(spark, M1, feats(spark, keys_1), db, "model_1_scores", run, now=NOW, buckets=b1)
    score_job(spark, M2, feats(spark, keys_2), db, "model_2_scores", run, now=NOW, buckets=b2)
    return [f"{db}.model_{k}_scores" for k in (1, 2)]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"(?<!Reused)Exchange ", plan(df)))


def clustered(spark, tables, run="r1"):
    s1, s2 = (read_run_by_key(spark, t, run).where("id IS NOT NULL") for t in tables)
    return merge_unique(s1, s2, now=NOW, clustered=True)


def test_no_exchange_between_the_scans_and_the_merge(spark, db):
    tables = both(spark, db, 6, 6)
    merged = clustered(spark, tables)
    assert exchanges(merged) == 0 and plan(merged).count("Bucketed: true") == 2
    plain = merge_unique(*[read_run(spark, t, "r1") for t in tables], now=NOW)
    assert exchanges(plain) == 1
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, plain.collect())) and merged.count() == 5


@pytest.mark.parametrize("b1, b2", [(4, 6), (6, None), (None, None), (1, 8)])
def test_other_bucket_counts_fall_back_to_a_shuffle_with_the_same_rows(spark, db, b1, b2):
    tables = both(spark, db, b1, b2)
    merged = clustered(spark, tables)
    assert exchanges(merged) >= 1
    assert sorted(r["id"] for r in merged.collect()) == list("bcdef")
    job = merge_job(spark, db, "r1", now=NOW)
    assert job.rows == 5 and job.details["join"] == check_join(*[read_run(spark, t, "r1") for t in tables]).first().asDict()


def test_merge_job_on_buckets_counts_as_the_plain_one(spark, db):
    """Rows without a key, a third of all, and unmatched ones on both sides."""
    keys = [*"abcdef", *[None] * 4]
    tables = both(spark, db, 5, 5, keys, [*"bcdefg", *[None] * 3])
    job = merge_job(spark, db, "r1", now=NOW)
    want = check_join(*[read_run(spark, t, "r1") for t in tables]).first().asDict()
    assert job.details["join"] == want and want["n1"] == 10 and job.rows == 5


def test_rows_without_a_key_are_spread_over_files(spark, db):
    t = f"{db}.model_1_scores"
    score_job(spark, M1, feats(spark, [None] * 300 + [str(k) for k in range(600)]), db, "model_1_scores", "r1", now=NOW, buckets=8)
    per = read_run(spark, t, "r1").where("id IS NULL").groupBy(F.input_file_name()).count().collect()
    assert len(per) == 8 and max(r["count"] for r in per) < 100
    # with a key: one file a bucket
    per = read_run(spark, t, "r1").where("id IS NOT NULL").groupBy(F.input_file_name()).count().collect()
    assert len(per) == 8


def test_duplicate_in_a_bucketed_run_fails_the_merge_and_keeps_the_earlier_one(spark, db):
    both(spark, db, 4, 4)
    merge_job(spark, db, "r1", now=NOW)
    score_job(spark, M2, feats(spark, [*"bcdefg", "zz", "zz"]), db, "model_2_scores", "r1", now=NOW, buckets=4, force=True)
    with pytest.raises(ValueError, match="duplicate id"):
        merge_job(spark, db, "r1", now=NOW, force=True)
    assert read_run(spark, f"{db}.merged_model_scores", "r1").count() == 5


def test_replacing_a_run_replaces_its_buckets(spark, db):
    t = f"{db}.model_1_scores"
    for buckets, keys in ((4, "abc"), (None, "abcd"), (7, "abcde"), (3, "x")):
        score_job(spark, M1, feats(spark, keys), db, "model_1_scores", "r1", now=NOW, buckets=buckets, force=True)
        assert run_buckets(spark, t, "r1") == buckets
        for df in (read_run(spark, t, "r1"), read_run_by_key(spark, t, "r1"), spark.table(t)):
            assert sorted(r["id"] for r in df.collect()) == list(keys)
    # An empty run has no buckets, and counts as not done.
    empty = score_frame(feats(spark, "a").where("false"), M1, now=NOW).withColumn("scoring_timestamp", F.col("scoring_timestamp").cast("timestamp"))
    assert write_run(empty, t, "r1", buckets=3) == 0
    assert not run_exists(spark, t, "r1") and read_run_by_key(spark, t, "r1").count() == 0


def test_runs_with_and_without_buckets_in_one_table(spark, db):
    t = f"{db}.model_1_scores"
    for run, buckets in (("r1", 4), ("r2", 9), ("r3", None)):
        score_job(spark, M1, feats(spark, "abcdefgh"), db, "model_1_scores", run, now=NOW, buckets=buckets)
    # The table itself declares no buckets: grouping all runs by key is right whatever theirs are.
    assert {r["count"] for r in spark.table(t).groupBy("id").count().collect()} == {3}
    assert {r["run_id"]: r["m"] for r in run_status(spark, {"m": t}).collect()} == {"r1": 8, "r2": 8, "r3": 8}
    assert run_buckets(spark, t, "none") is None and read_run_by_key(spark, t, "none").count() == 0


def test_a_run_without_its_mark_is_not_taken_for_bucketed(spark, db):
    """The writer ended between the commit and the mark."""
    tables = both(spark, db, 4, 4)
    folder = run_folder(spark, tables[0], "r1").removeprefix("file:")
    marks = [f for f in os.listdir(folder) if f.startswith("_buckets-")]
    assert marks == ["_buckets-4"]
    os.rename(f"{folder}/_buckets-4", f"{folder}/_other")
    assert run_buckets(spark, tables[0], "r1") is None
    assert merge_job(spark, db, "r1", now=NOW).rows == 5


def test_features_clustered_alike_are_scored_without_a_shuffle(spark, db):
    f = feats(spark, [str(k) for k in range(200)])
    f.write.bucketBy(4, "id").option("path", f"{fx_folder(spark, db)}/features").saveAsTable(f"{db}.features")
    t = f"{db}.model_1_scores"
    frame = score_frame(spark.table(f"{db}.features"), M1, now=NOW).withColumn("scoring_timestamp", F.col("scoring_timestamp").cast("timestamp"))
    write_run(frame, t, "r1", contract=score_contract("model_1"), buckets=4, dealt=True)
    assert run_buckets(spark, t, "r1") == 4
    got = read_run_by_key(spark, t, "r1").groupBy("id").count()
    assert exchanges(got) == 0 and got.count() == 200
    with pytest.raises(ValueError, match="no rebalance"):
        write_run(frame, t, "r1", buckets=4, rebalance=True)


def fx_folder(spark, db):
    return spark.catalog.getDatabase(db).locationUri


def test_fixture_merge_is_the_same_in_buckets(spark, db):
    score_job(spark, fx.MODEL_1, fx.features(spark, SF_SMALL), db, "model_1_scores", fx.RUN, now=fx.NOW, buckets=8)
    score_job(spark, fx.MODEL_2, fx.model_2_features(spark, SF_SMALL), db, "model_2_scores", fx.RUN, now=fx.NOW, buckets=8)
    tables = [f"{db}.model_{k}_scores" for k in (1, 2)]
    plain = merge_unique(*[read_run(spark, t, fx.RUN) for t in tables], now=fx.NOW)
    assert sorted(map(str, clustered(spark, tables, fx.RUN).collect())) == sorted(map(str, plain.collect()))
