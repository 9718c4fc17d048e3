"""As-of join: to each row, the values that were current at its time.

Both sides run through one ordered stream per key, in which the last values seen
are carried to the rows that follow; there is no join.  A key's stream is cut into
slices of time, and each slice gets what the slices before it ended with as its
first row, so a key with a third of all rows is worked on by as many tasks as it
has slices.  The cuts are quantiles of the times of both sides, one short array;
where they lie changes no result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cuts(times: DataFrame, slices: int) -> list[Column]:
    """Up to ``slices`` - 1 times that part the rows of ``times`` (t) about evenly."""
    if slices < 2:
        return []
    shares = [k / slices for k in range(1, slices)]
    found = times.agg(F.percentile_approx("t", shares, 10_000).alias("t")).first()["t"]
    # As text: a wall-clock time must not pass through a time zone.
    return [F.lit(str(t)).cast(times.schema["t"].dataType) for t in sorted(set(found or []))]


def _slice(t: Column, cuts: Sequence[Column]) -> Column:
    """How many cuts lie at or before ``t``."""
    return reduce(lambda a, b: a + b, [(t >= c).cast("int") for c in cuts], F.lit(0))


def as_of(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    at: str,
    since: str,
    values: Sequence[str],
    slices: int = 64,
) -> DataFrame:
    """``left`` with the ``values`` of the latest row of ``right`` with the same ``by`` and ``since`` <= ``at``.

    Times are compared as the type of ``at``.
    Values are NULL where there is no such row, and where ``by`` or ``at`` is NULL;
    rows of ``right`` without ``by`` or ``since`` match nothing.  Of rows of
    ``right`` with the same key and time the one with the largest values, in their
    order, counts.  Every row of ``left`` comes back once, repeated ones as often.
    """
    clash = [v for v in values if v in left.columns]
    if clash:
        raise ValueError(f"column(s) {clash} are on both sides")
    keys = [F.col(k).alias(f"_k{n}") for n, k in enumerate(by)]
    names = [f"_k{n}" for n in range(len(by))]
    usable = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*by, at)])
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    value = F.struct(*[F.col(v) for v in values])
    kind = left.schema[at].dataType
    lefts = left.where(usable).select(*keys, F.col(at).alias("_t"), row.alias("_row"))
    there = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*by, since)])
    rights = right.where(there).select(*keys, F.col(since).cast(kind).alias("_t"), value.alias("_v"))
    cuts = _cuts(lefts.select(F.col("_t").alias("t")).unionByName(rights.select(F.col("_t").alias("t"))), slices)
    lefts, rights = (x.withColumn("_s", _slice(F.col("_t"), cuts)) for x in (lefts, rights))

    # What each slice of a key ends with; and, for slices with rows of the left,
    # what those before it ended with: at most ``slices`` rows a key here.
    none = F.lit(None).cast(rights.schema["_v"].dataType)
    ends = rights.groupBy(*names, "_s").agg(F.max(F.struct("_t", "_v")).alias("_end"))
    wanted = lefts.groupBy(*names, "_s").agg(F.lit(True).alias("_wanted"))
    ends = ends.select(*names, "_s", F.col("_end._v").alias("_v"), F.lit(False).alias("_wanted"))
    both = ends.unionByName(wanted.select(*names, "_s", none.alias("_v"), "_wanted"))
    per = both.groupBy(*names, "_s").agg(F.max("_v").alias("_v"), F.max("_wanted").alias("_wanted"))
    earlier = Window.partitionBy(*names).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    carried = per.withColumn("_v", F.last("_v", ignorenulls=True).over(earlier)).where(F.col("_wanted") & F.col("_v").isNotNull())

    no_row = F.lit(None).cast(lefts.schema["_row"].dataType)
    stream = [
        carried.select(*names, "_s", F.lit(None).cast(kind).alias("_t"), F.lit(0).alias("_tag"), "_v", no_row.alias("_row")),
        rights.select(*names, "_s", "_t", F.lit(0).alias("_tag"), "_v", no_row.alias("_row")),
        lefts.select(*names, "_s", "_t", F.lit(1).alias("_tag"), none.alias("_v"), "_row"),
    ]
    # At one time the values come before the rows that they are for.
    order = Window.partitionBy(*names, "_s").orderBy(F.col("_t").asc_nulls_first(), "_tag", "_v")
    until = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = reduce(DataFrame.unionByName, stream).withColumn("_v", F.last("_v", ignorenulls=True).over(until))
    found = found.where(F.col("_tag") == 1).select("_row.*", *[F.col(f"_v.`{v}`").alias(v) for v in values])
    kinds = right.select(*values).schema
    unknown = left.where(~F.coalesce(usable, F.lit(False)))
    return found.unionByName(unknown.select(*[F.col(f"`{c}`") for c in left.columns], *[F.lit(None).cast(kinds[v].dataType).alias(v) for v in values]))
