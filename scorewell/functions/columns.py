"""Column-level helpers: run ids, NaN handling, ensemble rules.

All of these build JVM-side expressions, so they stay inside whole-stage
codegen.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the run id format, to the second.
RUN_ID_FORMAT = "yyyyMMdd_HHmmss"
RUN_ID_PY_FORMAT = "%Y%m%d_%H%M%S"

Ensemble = Callable[[Sequence[Column]], Column]


def run_id_of(ts: Column, dtype: T.DataType | None = None) -> Column:
    """``yyyyMMdd_HHmmss`` of a timestamp, as UTC wall-clock time.

    TIMESTAMP_NTZ values are formatted as they are.  Zoned timestamps are
    first shifted to UTC wall-clock so the id does not depend on the
    session time zone.
    """
    if isinstance(dtype, T.TimestampType):
        ts = F.to_utc_timestamp(ts, F.current_timezone())
    return F.date_format(ts, RUN_ID_FORMAT)


def run_id_for(moment: _dt.datetime) -> str:
    """Python-side run id of a moment; naive values are taken as UTC."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return moment.strftime(RUN_ID_PY_FORMAT)


def nan_to_null(c: Column) -> Column:
    """NaN predictions are stored as NULL on every scoring path."""
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def as_timestamp(now) -> Column:
    """``now`` as a column: None -> current_timestamp(); str -> TIMESTAMP_NTZ.

    An aware datetime is stored as its UTC wall-clock time, as in run ids.
    """
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    if isinstance(now, str):
        return F.lit(now).cast("timestamp_ntz")
    if isinstance(now, _dt.datetime):
        if now.tzinfo is not None:
            now = now.astimezone(_dt.timezone.utc)
        return F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    raise TypeError(f"unsupported timestamp value: {now!r}")


def within_inputs(rule: Ensemble) -> Ensemble:
    """Marks a rule whose result lies between the least and the greatest score it is given."""
    rule.within_inputs = True
    return rule


@within_inputs
def mean_ensemble(scores: Sequence[Column]) -> Column:
    """Plain mean; NULL if any input is NULL (no coalesce)."""
    total = reduce(lambda a, b: a + b, scores)
    return total / F.lit(float(len(scores)))


def weighted_ensemble(weights: Sequence[float], digits: int | None = None) -> Ensemble:
    """Weighted sum of the scores, optionally rounded.

    With weights that are shares of 1 and no rounding it lies between the scores.
    """

    def rule(scores: Sequence[Column]) -> Column:
        if len(scores) != len(weights):
            raise ValueError(f"{len(weights)} weights for {len(scores)} scores")
        terms = [s * F.lit(float(w)) for s, w in zip(scores, weights)]
        out = reduce(lambda a, b: a + b, terms)
        return F.round(out, digits) if digits is not None else out

    shares = all(w >= 0 for w in weights) and sum(weights) == 1
    return within_inputs(rule) if shares and digits is None else rule
