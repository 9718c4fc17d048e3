"""Runs that are due and missing, and the gaps that they form."""

import datetime as dt
import random

import pytest

from scorewell.functions.models import LinearModel
from scorewell.plans.jobs import score_job
from scorewell.sources.schedule import due_times, gaps, missing_of_tables, missing_runs

D0 = dt.datetime(2026, 3, 1)
DAY = dt.timedelta(days=1)


def stored_frame(spark, rows):
    return spark.createDataFrame([(t, None if k is None else D0 + k * DAY) for t, k in rows], "table string, at timestamp_ntz")


def tables_frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "table string")


def brute(rows, names, last, every=DAY, n=None):
    out = []
    for name in sorted(set(names)):
        lost = [k for k in range(last + 1) if (name, k) not in rows]
        while lost:
            run = [lost.pop(0)]
            while lost and lost[0] == run[-1] + 1:
                run.append(lost.pop(0))
            out.append((name, D0 + run[0] * DAY, D0 + run[-1] * DAY, len(run)))
    return out


def found(df):
    return sorted(tuple(r[c] for c in ("table", "first", "last", "runs")) for r in df.collect())


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_gaps_equal_brute_force_across_a_change_of_clocks(spark, zone):
    """March has a day of 23 hours in the second zone."""
    rnd = random.Random(3)
    names = [f"t{k}" for k in range(12)] + ["none", "full"]
    rows = {(f"t{k}", rnd.randrange(31)) for k in range(12) for _ in range(25)} | {("full", k) for k in range(31)}
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stored = stored_frame(spark, [*rows, *rows, ("t1", None), ("other", 4)])  # repeated, without a time, of another table
        got = found(gaps(missing_runs(stored, tables_frame(spark, [*names, "t1"]), D0, D0 + 30 * DAY)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == brute(rows, names, 30)
    assert ("none", D0, D0 + 30 * DAY, 31) in got and not any(g[0] == "full" for g in got)


def test_runs_off_the_schedule_fill_no_gap(spark):
    stored = spark.createDataFrame([("t", D0 + dt.timedelta(hours=5)), ("t", D0 + DAY)], "table string, at timestamp_ntz")
    missing = missing_runs(stored, tables_frame(spark, ["t"]), D0, D0 + 2 * DAY)
    assert sorted(r["due"] for r in missing.collect()) == [D0, D0 + 2 * DAY]


def test_hourly_schedule_and_a_calendar_of_each_table(spark):
    hour = dt.timedelta(hours=1)
    tables = spark.createDataFrame([("a", D0, D0 + 5 * hour), ("b", D0 + 3 * hour, D0 + 3 * hour), ("c", D0 + hour, D0), ("d", None, D0)],
                                   "table string, first timestamp_ntz, last timestamp_ntz")
    due = due_times(tables, tables["first"], tables["last"], hour)
    assert {(r["table"], r["due"]) for r in due.collect()} == {("a", D0 + k * hour) for k in range(6)} | {("b", D0 + 3 * hour)}
    stored = spark.createDataFrame([("a", D0 + 2 * hour)], "table string, at timestamp_ntz")
    got = found(gaps(missing_runs(stored, tables.where("table < 'c'"), tables["first"], tables["last"], hour), hour))
    assert got == [("a", D0, D0 + hour, 2), ("a", D0 + 3 * hour, D0 + 5 * hour, 3), ("b", D0 + 3 * hour, D0 + 3 * hour, 1)]


def test_nothing_missing_and_nothing_due(spark):
    stored = stored_frame(spark, [("t", 0), ("t", 1)])
    names = tables_frame(spark, ["t"])
    assert gaps(missing_runs(stored, names, D0, D0 + DAY)).count() == 0
    assert missing_runs(stored, names.where("false"), D0, D0 + DAY).count() == 0
    assert missing_runs(stored.where("false"), names, D0, D0 + DAY).count() == 2


def test_a_third_of_rows_on_one_run_is_one_row_a_task(spark):
    stored = stored_frame(spark, [("t", 1)] * 2000 + [("t", k) for k in (0, 3)]).repartition(6)
    df = missing_runs(stored, tables_frame(spark, ["t"]), D0, D0 + 4 * DAY)
    assert sorted(r["due"] for r in df.collect()) == [D0 + 2 * DAY, D0 + 4 * DAY]
    assert "partial_max" in df._jdf.queryExecution().executedPlan().toString() and "Join" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_missing_runs_of_stored_tables(spark, db):
    m = LinearModel.of("model_1", {"x": 0.5})
    f = spark.createDataFrame([("a", 1.0)], "id string, x double")
    for run in ("20260301_000000", "20260303_000000", "backfill"):
        score_job(spark, m, f, db, "model_1_scores", run, now="2026-01-01 12:00:00")
    got = missing_of_tables(spark, {"m1": f"{db}.model_1_scores"}, D0, D0 + 3 * DAY).collect()
    assert sorted((r["table"], r["run_id"]) for r in got) == [("m1", "20260302_000000"), ("m1", "20260304_000000")]
