"""Feature sets whose parts have different schemas."""

import datetime as dt
import itertools
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from scorewell.functions.models import LinearModel
from scorewell.operators.score import score
from scorewell.session import scratch_location
from scorewell.sources.evolution import read_evolved_features, reconcile, schema_changes, wider


def part(spark, folder, name, rows, ddl):
    spark.createDataFrame(rows, ddl).write.parquet(f"{folder}/{name}")
    return f"{folder}/{name}"


@pytest.fixture()
def folder(spark):
    return scratch_location(spark, "parts")


def test_added_missing_and_widened_columns_in_one_scan(spark, folder):
    d = dt.date(2026, 1, 2)
    paths = [
        part(spark, folder, "a", [("1", 5, 1.5, 7, d)], "id string, n int, x float, old int, day date"),
        part(spark, folder, "b", [("2", 2**40, 0.1, dt.datetime(2026, 1, 3, 4), True)], "id string, n bigint, x double, day timestamp_ntz, new boolean"),
        part(spark, folder, "c", [("3", 3)], "id string, n tinyint"),
    ]
    df = read_evolved_features(spark, [*paths, paths[0]])  # a path given twice is read once
    assert df.dtypes == [("id", "string"), ("n", "bigint"), ("x", "double"), ("old", "int"), ("day", "timestamp_ntz"), ("new", "boolean")]
    assert sorted(map(tuple, df.collect()), key=str) == [
        ("1", 5, 1.5, 7, dt.datetime(2026, 1, 2), None), ("2", 2**40, 0.1, None, dt.datetime(2026, 1, 3, 4), True), ("3", 3, None, None, None, None)]
    plan = df.select("id", "n")._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and plan.count("FileScan") == 1 and "ReadSchema: struct<id:string,n:bigint>" in plan
    pushed = df.where("n > 10").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(n,10)" in pushed and [r["id"] for r in df.where("n > 10").collect()] == ["2"]
    changes = {(r["path"][-1], r["column"], r["change"], r["from"], r["to"]) for r in schema_changes(spark, paths).collect()}
    assert ("a", "n", "widened", "int", "bigint") in changes and ("c", "x", "missing", None, "double") in changes
    assert ("b", "old", "missing", None, "int") in changes and len([c for c in changes if c[0] == "b"]) == 1


def test_decimals_widen_and_become_doubles(spark, folder):
    paths = [part(spark, folder, "a", [("1", Decimal("1.25"))], "id string, p decimal(6,2)"), part(spark, folder, "b", [("2", Decimal("7.125"))], "id string, p decimal(9,3)")]
    assert sorted(map(tuple, read_evolved_features(spark, paths).collect())) == [("1", 1.25), ("2", 7.125)]
    assert read_evolved_features(spark, paths, decimals_to_double=False).schema["p"].dataType == T.DecimalType(9, 3)


def test_conflicts_by_rule(spark, folder):
    paths = [
        part(spark, folder, "a", [("1", 5, 1.0)], "id string, v int, w double"),
        part(spark, folder, "b", [("2", "five", 2.0), ("4", None, 2.5)], "id string, v string, w double"),
        part(spark, folder, "c", [("3", 3.0)], "id string, w double"),
    ]
    with pytest.raises(ValueError, match="no common type for 'v' is int and string"):
        read_evolved_features(spark, paths)
    text = read_evolved_features(spark, paths, on_conflict="text")
    assert text.columns == ["id", "w", "v"]
    assert sorted(map(tuple, text.collect())) == [("1", 1.0, "5"), ("2", 2.0, "five"), ("3", 3.0, None), ("4", 2.5, None)]
    assert read_evolved_features(spark, paths, on_conflict="drop").columns == ["id", "w"]
    with pytest.raises(ValueError, match="unknown rule"):
        read_evolved_features(spark, paths, on_conflict="guess")


def test_the_key_must_be_there_and_of_one_type(spark, folder):
    a = part(spark, folder, "a", [("1", 5)], "id string, v int")
    b = part(spark, folder, "b", [(5,)], "v int")
    c = part(spark, folder, "c", [(True, 5)], "id boolean, v int")
    with pytest.raises(ValueError, match="/b: key column 'id' not found"):
        read_evolved_features(spark, [a, b])
    with pytest.raises(ValueError, match="no common type for 'id'"):
        read_evolved_features(spark, [a, c], on_conflict="text")


def test_evolved_features_are_scored(spark, folder):
    """A part without a feature has no scores; the model's column pruning reaches the scan."""
    paths = [part(spark, folder, "a", [(1, 2.0)], "id int, x float"), part(spark, folder, "b", [(2, 3.0, "t")], "id bigint, x double, note string"), part(spark, folder, "c", [(3,)], "id int")]
    got = {r["id"]: r["m_prediction"] for r in score(read_evolved_features(spark, paths), LinearModel.of("m", {"x": 0.5})).select("id", "m_prediction").collect()}
    assert got == {1: 1.0, 2: 1.5, 3: None}


def test_wider_holds_every_value_of_both(spark):
    kinds = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DateType(), T.TimestampNTZType(), T.StringType(), T.DecimalType(5, 2), T.DecimalType(38, 0), T.NullType()]
    for a, b in itertools.product(kinds, kinds):
        assert wider(a, b) == wider(b, a)
    assert wider(T.LongType(), T.DoubleType()) is None  # 2^53 + 1 isn't a double
    assert wider(T.IntegerType(), T.FloatType()) == T.DoubleType() and wider(T.ShortType(), T.FloatType()) == T.DoubleType() and wider(T.IntegerType(), T.DoubleType()) == T.DoubleType()
    assert wider(T.DecimalType(5, 2), T.LongType()) == T.DecimalType(21, 2) and wider(T.DecimalType(38, 0), T.DecimalType(5, 2)) is None
    assert wider(T.StringType(), T.NullType()) == T.StringType()
    assert reconcile({}).schema == T.StructType([])


def test_the_order_of_the_parts_changes_no_type():
    kinds = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(5, 2), T.StringType()]
    for some in itertools.combinations(kinds, 3):
        found = set()
        for order in itertools.permutations(some):
            r = reconcile({str(n): T.StructType([T.StructField("x", k)]) for n, k in enumerate(order)})
            found.add(r.schema["x"].dataType.simpleString() if "x" in r.schema.names else None)
        assert len(found) == 1, some


def test_narrow_whole_numbers_with_floats(spark, folder):
    paths = [part(spark, folder, n, [(n, 3)], f"id string, x {k}") for n, k in (("a", "int"), ("b", "smallint"))]
    paths.append(part(spark, folder, "c", [("c", 0.5)], "id string, x float"))
    assert sorted(map(tuple, read_evolved_features(spark, paths).collect())) == [("a", 3.0), ("b", 3.0), ("c", 0.5)]
    assert sorted(map(tuple, read_evolved_features(spark, paths[1:]).collect())) == [("b", 3.0), ("c", 0.5)]
