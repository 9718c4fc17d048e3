"""Feature sets whose parts were written with different schemas.

A feature set is a list of paths (days, backfills), each written by one job and so
of one schema; the schemas are reconciled before anything is scanned.  A column
that some parts lack is NULL there.  A column whose types differ is read in the
narrowest type that holds all of them exactly, which Parquet's reader does by
itself, so that all parts are one scan.  Types that have none in common are a
conflict, and a rule says what to do: fail, read the column as text, or leave it out.

Only schemas pass through the driver: one footer a path.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewell.sources.features import doubles_for_decimals

CONFLICT_RULES = ("error", "text", "drop")
_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
#: Digits that a decimal needs for each of them.
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds every value of both exactly and that files of both can be read in, or None.

    Whole numbers widen among each other and, up to 32 bits, with float and double to
    double; decimals, and whole numbers with them, to enough digits (38 at most); dates
    to timestamps without a zone; a column that is NULL throughout to anything.
    """
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if a in _WHOLE and b in _WHOLE:
        return _WHOLE[max(_WHOLE.index(a), _WHOLE.index(b))]
    kinds = {type(a), type(b)}
    if kinds <= {T.FloatType, T.DoubleType, *map(type, _WHOLE[:3])}:
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if T.DecimalType in kinds:
        pairs = [_precision(t) for t in (a, b)]
        if None not in pairs:
            scale = max(s for _, s in pairs)
            digits = max(p - s for p, s in pairs) + scale
            return T.DecimalType(digits, scale) if digits <= 38 else None
    return None


def _precision(t: T.DataType) -> tuple[int, int] | None:
    if isinstance(t, T.DecimalType):
        return t.precision, t.scale
    return (_DIGITS[t.simpleString()], 0) if t in _WHOLE else None


@dataclass(frozen=True)
class Reconciled:
    """The columns of all parts, and how they came about."""

    schema: T.StructType
    #: Columns without a common type: {column: types as text}.
    conflicts: dict[str, list[str]]
    #: (path, column, change, type in the path, type read): change is missing, widened or conflict.
    changes: list[tuple[str, str, str, str | None, str | None]]


def reconcile(schemas: dict[str, T.StructType]) -> Reconciled:
    """Schemas by path, in the order that columns first appear in."""
    kinds: dict[str, T.DataType | None] = {}
    found: dict[str, list[str]] = {}
    for schema in schemas.values():
        for f in schema.fields:
            text = f.dataType.simpleString()
            if text not in found.setdefault(f.name, []):
                found[f.name].append(text)
            kinds[f.name] = f.dataType if f.name not in kinds else kinds[f.name] and wider(kinds[f.name], f.dataType)
    changes = []
    for path, schema in schemas.items():
        have = {f.name: f.dataType for f in schema.fields}
        for name, kind in kinds.items():
            mine, read = have.get(name), kind and kind.simpleString()
            if mine is None:
                changes.append((path, name, "missing", None, read))
            elif kind is None:
                changes.append((path, name, "conflict", mine.simpleString(), None))
            elif mine != kind:
                changes.append((path, name, "widened", mine.simpleString(), read))
    merged = T.StructType([T.StructField(n, k) for n, k in kinds.items() if k is not None])
    return Reconciled(merged, {n: found[n] for n, k in kinds.items() if k is None}, changes)


def schemas_of(spark: SparkSession, paths: Sequence[str], threads: int = 8) -> dict[str, T.StructType]:
    """{path: schema}, from one footer a path."""
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return dict(zip(paths, pool.map(lambda p: spark.read.parquet(p).schema, paths)))


def read_evolved_features(
    spark: SparkSession,
    paths: Sequence[str],
    id_col: str = "id",
    on_conflict: str = "error",
    decimals_to_double: bool = True,
) -> DataFrame:
    """All parts of a feature set under their reconciled schema.

    The key column must be in every part, and without a conflict whatever the rule.
    Columns in conflict come last with ``on_conflict="text"``: as a cast of each
    part's value to text.
    """
    if on_conflict not in CONFLICT_RULES:
        raise ValueError(f"unknown rule {on_conflict!r}; expected one of {CONFLICT_RULES}")
    paths = list(dict.fromkeys(paths))
    schemas = schemas_of(spark, paths)
    for path, schema in schemas.items():
        if id_col not in schema.names:
            raise ValueError(f"feature set {path}: key column {id_col!r} not found")
    plan = reconcile(schemas)
    if plan.conflicts and (on_conflict == "error" or id_col in plan.conflicts):
        named = "; ".join(f"{c!r} is {' and '.join(kinds)}" for c, kinds in plan.conflicts.items())
        raise ValueError(f"feature set of {len(paths)} parts: no common type for {named}")
    as_text = plan.conflicts if on_conflict == "text" else {}
    # One scan for all parts, or, for columns read as text, one for each set of their types.
    groups: dict[tuple, list[str]] = {}
    for path, schema in schemas.items():
        have = {f.name: f.dataType for f in schema.fields}
        groups.setdefault(tuple((c, have[c]) for c in as_text if c in have), []).append(path)
    parts = []
    for own, members in groups.items():
        scanned = spark.read.schema(T.StructType([*plan.schema.fields, *(T.StructField(c, t) for c, t in own)])).parquet(*members)
        have = dict(own)
        texts = [(F.col(f"`{c}`").cast("string") if c in have else F.lit(None).cast("string")).alias(c) for c in as_text]
        parts.append(scanned.select(*[F.col(f"`{n}`") for n in plan.schema.names], *texts))
    out = reduce(DataFrame.unionByName, parts)
    return doubles_for_decimals(out) if decimals_to_double else out


def schema_changes(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, column, change, from, to) of every difference between the parts."""
    rows = reconcile(schemas_of(spark, list(dict.fromkeys(paths)))).changes
    return spark.createDataFrame(rows, "path string, column string, change string, `from` string, `to` string")
