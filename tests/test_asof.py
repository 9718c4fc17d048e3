"""The version that was current at a run: the as-of join against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from scorewell.operators.asof import as_of
from scorewell.sources.registry import resolve_at, versions_at

T0 = dt.datetime(2026, 1, 1)


def at(k):
    return None if k is None else T0 + dt.timedelta(minutes=k)


def frames(spark, runs, versions, parts=3):
    left = spark.createDataFrame([(n, k, at(t)) for n, (k, t) in enumerate(runs)], "run int, name string, at timestamp_ntz")
    right = spark.createDataFrame([(k, at(t), v) for k, t, v in versions], "name string, since timestamp_ntz, version int")
    return left.repartition(parts), right.repartition(parts)


def brute(runs, versions):
    out = []
    for n, (k, t) in enumerate(runs):
        known = [(s, v is not None, v) for k2, s, v in versions if k2 is not None and k2 == k and s is not None and t is not None and s <= t]
        out.append((n, max(known)[2] if known else None))
    return out


def got(df):
    return sorted((r["run"], r["version"]) for r in df.select("run", "version").collect())


@pytest.mark.parametrize("slices", [1, 2, 7, 64])
def test_equals_brute_force_with_a_third_of_runs_on_one_model(spark, slices):
    rnd = random.Random(slices)
    names = ["hot"] + [f"m{k}" for k in range(20)] + [None]
    runs = [("hot" if rnd.random() < 1 / 3 else rnd.choice(names), rnd.choice([None, *range(500)])) for _ in range(1500)]
    versions = [(rnd.choice(names), rnd.choice([None, *range(20, 480)]), rnd.randrange(1000)) for _ in range(150)]
    versions += [("m3", 50, None), ("m3", 50, 4), ("late", 9999, 1)]
    left, right = frames(spark, runs, versions, 5)
    df = as_of(left, right, ["name"], "at", "since", ["version"], slices)
    assert df.columns == ["run", "name", "at", "version"] and got(df) == sorted(brute(runs, versions))


def test_a_hot_model_is_worked_on_in_slices(spark):
    """No task has more than its slice: the stream is dealt by model and slice, and there is no join."""
    runs = [("hot", k % 1000) for k in range(3000)] + [(f"m{k}", k % 1000) for k in range(6000)]
    left, right = frames(spark, runs, [("hot", 10 * k, k) for k in range(100)])
    df = as_of(left, right, ["name"], "at", "since", ["version"], 16)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    sizes = df.where("name = 'hot'").groupBy("version").count().collect()
    assert sum(r["count"] for r in sizes) == 3000 and len(sizes) == 100
    spread = df.select(F.spark_partition_id().alias("p"), "name").where("name = 'hot'").groupBy("p").count().collect()
    assert len(spread) > 1 and max(r["count"] for r in spread) < 2000


def test_ties_repeated_rows_and_times_at_the_edge(spark):
    runs = [("a", 5), ("a", 5), ("a", 4), ("b", 5), ("a", None), (None, 5)]
    versions = [("a", 5, 1), ("a", 5, 9), ("a", 5, 3), ("a", 6, 100), (None, 1, 7)]
    for slices in (1, 2, 5):
        assert got(as_of(*frames(spark, runs, versions), ["name"], "at", "since", ["version"], slices)) == brute(runs, versions)


def test_several_keys_and_values_and_null_fields(spark):
    left = spark.createDataFrame([("a", "x", 3, "p"), ("a", "y", 3, "q"), ("a", "x", 9, None)], "k string, stage string, t int, _t string")
    right = spark.createDataFrame([("a", "x", 1, 1, "one"), ("a", "x", 5, None, "two"), ("b", "y", 1, 2, "z")], "k string, stage string, s bigint, version int, note string")
    rows = as_of(left, right, ["k", "stage"], "t", "s", ["version", "note"]).collect()
    assert sorted(map(tuple, rows), key=str) == sorted([("a", "x", 3, "p", 1, "one"), ("a", "y", 3, "q", None, None), ("a", "x", 9, None, None, "two")], key=str)
    with pytest.raises(ValueError, match="on both sides"):
        as_of(left, right, ["k"], "t", "s", ["stage"])


def test_empty_sides(spark):
    left, right = frames(spark, [("a", 1), ("b", 2)], [("a", 0, 1)])
    assert as_of(left.where("false"), right, ["name"], "at", "since", ["version"]).count() == 0
    assert got(as_of(left, right.where("false"), ["name"], "at", "since", ["version"])) == [(0, None), (1, None)]


def test_version_and_uri_of_a_moment(spark):
    reg = spark.createDataFrame([("m", at(1), "9"), ("m", at(2), "10"), ("m", at(2), "9"), ("m", at(30), "11"), ("n", at(1), "1")], "name string, since timestamp_ntz, version string")
    assert resolve_at(reg, "m", at(29)) == ("models:/m/10", "10")  # as numbers
    assert resolve_at(reg, "m", at(1)) == ("models:/m/9", "9")
    with pytest.raises(ValueError, match="no version of 'm'"):
        resolve_at(reg, "m", at(0))
    runs = spark.createDataFrame([(1, "m", at(5)), (2, "n", at(0))], "run int, name string, at timestamp_ntz")
    assert {r["run"]: (r["version"], r["model_uri"]) for r in versions_at(runs, reg).collect()} == {1: ("10", "models:/m/10"), 2: (None, None)}
