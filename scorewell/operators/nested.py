"""A frame's schema against a contract, through structs, arrays and maps.

Both schemas are walked together, by path: ``items.element.price`` is a field of
the structs in an array, ``tags.key`` and ``tags.value`` are a map's two sides.
Where the types of a leaf differ, the values that don't cast are counted in the
data with higher-order functions, inside the rows: nothing is exploded, and all
paths are counted in one aggregation.  Where all types agree no data is read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A count of bad values in a row, from a column that holds the path's parent.
Counter = Callable[[Column], Column]


@dataclass(frozen=True)
class PathCheck:
    path: str
    expected: str | None
    actual: str | None
    status: str
    #: For a leaf of another type: how to count, in one row's value of the top column.
    count: Counter | None = None
    top: str | None = None


def _not_casting(kind: T.DataType) -> Counter:
    return lambda c: F.when(c.isNotNull() & c.try_cast(kind).isNull(), 1).otherwise(0).cast("bigint")


def _in_field(name: str, inner: Counter) -> Counter:
    return lambda c: inner(c.getField(name))


def _in_elements(elements: Callable[[Column], Column], inner: Counter) -> Counter:
    """Over all elements of an array; a NULL array has none."""
    def count(c: Column) -> Column:
        return F.coalesce(F.aggregate(elements(c), F.lit(0).cast("bigint"), lambda n, x: n + inner(x)), F.lit(0).cast("bigint"))

    return count


def _walk(path: str, expected: T.DataType, actual: T.DataType) -> Iterator[tuple[PathCheck, Counter | None]]:
    """The checks at and under a path, each with its counter over the path's own value."""
    names = {"expected": expected.simpleString(), "actual": actual.simpleString()}
    if isinstance(expected, T.StructType) and isinstance(actual, T.StructType):
        have = {f.name: f.dataType for f in actual.fields}
        want = {f.name: f.dataType for f in expected.fields}
        for name, kind in want.items():
            if name not in have:
                yield PathCheck(f"{path}.{name}", kind.simpleString(), None, "missing"), None
                continue
            for check, count in _walk(f"{path}.{name}", kind, have[name]):
                yield check, count and _in_field(name, count)
        for name, kind in have.items():
            if name not in want:
                yield PathCheck(f"{path}.{name}", None, kind.simpleString(), "unexpected"), None
    elif isinstance(expected, T.ArrayType) and isinstance(actual, T.ArrayType):
        for check, count in _walk(f"{path}.element", expected.elementType, actual.elementType):
            yield check, count and _in_elements(lambda c: c, count)
    elif isinstance(expected, T.MapType) and isinstance(actual, T.MapType):
        sides = (("key", expected.keyType, actual.keyType, F.map_keys), ("value", expected.valueType, actual.valueType, F.map_values))
        for side, want_kind, have_kind, elements in sides:
            for check, count in _walk(f"{path}.{side}", want_kind, have_kind):
                yield check, count and _in_elements(elements, count)
    elif expected == actual:
        yield PathCheck(path, status="ok", **names), None
    elif any(isinstance(t, (T.StructType, T.ArrayType, T.MapType)) for t in (expected, actual)):
        yield PathCheck(path, status="other_kind", **names), None
    else:
        yield PathCheck(path, status="cast", **names), _not_casting(expected)


def walk(contract: T.StructType, schema: T.StructType) -> list[PathCheck]:
    """All paths of the contract and those that only the schema has."""
    have, out = {f.name: f.dataType for f in schema.fields}, []
    for field in contract.fields:
        if field.name not in have:
            out.append(PathCheck(field.name, field.dataType.simpleString(), None, "missing"))
            continue
        for check, count in _walk(field.name, field.dataType, have[field.name]):
            out.append(PathCheck(check.path, check.expected, check.actual, check.status, count, field.name))
    named = {f.name for f in contract.fields}
    return out + [PathCheck(n, None, kind.simpleString(), "unexpected") for n, kind in have.items() if n not in named]


def check_nested_schema(df: DataFrame, contract: T.StructType) -> DataFrame:
    """(path, expected, actual, status, bad_values, passed) per path.

    status: ok (same type) | cast (a leaf of another type, every value casts) |
    bad_values (some non-NULL values don't) | other_kind (a leaf against a struct,
    array or map, or two of those) | missing | unexpected.  Values are counted where
    they lie: elements of arrays, keys and values of maps each.  NULLs at any level
    hold no bad value.  A struct, array or map itself has no row, its parts do; an
    empty frame has no bad value.
    """
    checks = walk(contract, df.schema)
    counted = {n: c for n, c in enumerate(checks) if c.count is not None}
    if counted:
        sums = [F.coalesce(F.sum(c.count(F.col(f"`{c.top}`"))), F.lit(0)).alias(f"_bad_{n}") for n, c in counted.items()]
        one = df.agg(*sums)
    else:
        one = df.sparkSession.range(1)
    rows = []
    for n, c in enumerate(checks):
        bad = F.col(f"_bad_{n}") if n in counted else F.lit(0 if c.status == "ok" else None).cast("bigint")
        status = F.when(bad > 0, "bad_values").otherwise("cast") if n in counted else F.lit(c.status)
        passed = bad == 0 if n in counted else F.lit(c.status == "ok")
        rows.append(F.struct(
            F.lit(c.path).alias("path"), F.lit(c.expected).cast("string").alias("expected"), F.lit(c.actual).cast("string").alias("actual"),
            status.alias("status"), bad.alias("bad_values"), passed.alias("passed"),
        ))
    return one.select(F.inline(F.array(*rows)))


def nested_schema_check_rows(found: DataFrame) -> DataFrame:
    """The same as check rows for a report: one per path."""
    return found.select(
        F.lit("schema").alias("check"), F.concat_ws(":", "path", "status").alias("metric"),
        F.col("bad_values").cast("double").alias("value"), F.lit(None).cast("double").alias("threshold"), "passed",
    )
