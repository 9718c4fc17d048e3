"""Merging two score sets of a run: inner equi-join on the key + ensemble.

Plan shape: each side is projected to three thin columns (key, score,
time) before the join, so the one shuffle moves only those.  The join
strategy is left to AQE, which switches to a broadcast only when a side's
*measured* size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
and splits skewed partitions otherwise.  Catalyst infers ``id IS NOT NULL``
below the exchange, so NULL keys never reach the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from scorewell.contracts import (
    KEY_COLUMN,
    RUN_COLUMN,
    check_run_id,
    prediction_column,
    score_column,
    timestamp_column,
)
from scorewell.functions.columns import Ensemble, as_timestamp, mean_ensemble
from scorewell.sources.catalog import observed, require_columns


def score_view(df: DataFrame, model_name: str, key: str = KEY_COLUMN) -> DataFrame:
    """(key, {model}_score, {model}_timestamp) from a score table's rows."""
    pred = prediction_column(model_name)
    require_columns(df, [key, pred, "scoring_timestamp"], f"scores of {model_name}")
    return df.select(
        F.col(key),
        F.col(pred).alias(score_column(model_name)),
        F.col("scoring_timestamp").alias(timestamp_column(model_name)),
    )


def merge_scores(
    scores_1: DataFrame,
    scores_2: DataFrame,
    model_1: str = "model_1",
    model_2: str = "model_2",
    run_id: str | None = None,
    ensemble: Ensemble = mean_ensemble,
    now=None,
    key: str = KEY_COLUMN,
) -> DataFrame:
    """Inner join on ``key``; ``ensemble_score`` = ``ensemble([s1, s2])``.

    Output columns follow the merged contract: key, both scores, ensemble,
    both scoring times, merge time (and run id when given).  Duplicate keys
    multiply (n1 * n2 rows) as a join does; ``check_join`` reports them.
    """
    for side, name in ((scores_1, "first score set"), (scores_2, "second score set")):
        if key not in side.columns:
            raise ValueError(f"the {name} has no key column {key!r}")
    if model_1 == model_2:
        raise ValueError("the two models must have different names")
    left = score_view(scores_1, model_1, key)
    right = score_view(scores_2, model_2, key)
    s1, s2 = F.col(score_column(model_1)), F.col(score_column(model_2))
    joined = left.join(right, on=key, how="inner")
    cols = [
        F.col(key).alias(KEY_COLUMN),
        s1,
        s2,
        ensemble([s1, s2]).alias("ensemble_score"),
        F.col(timestamp_column(model_1)),
        F.col(timestamp_column(model_2)),
        as_timestamp(now).alias("merge_timestamp"),
    ]
    if run_id is not None:
        cols.append(F.lit(check_run_id(run_id)).alias(RUN_COLUMN))
    return joined.select(cols)


class MergeMetrics:
    """Join-completeness counts observed while ``merge_unique`` runs.

    Same fields as ``check_join``: n1, n2, matched, only_1, only_2, dup_ids,
    expected_rows.  They are observed after the shuffle, in the stage that
    writes, so a re-run map stage (lost executor) cannot count twice.
    """

    FIELDS = ("n1", "n2", "matched", "only_1", "only_2", "dup_ids", "expected_rows")

    def __init__(self):
        self.observation = Observation()
        #: Rows without a key on each side that the merge itself doesn't read.
        self.keyless = (0, 0)

    def get(self) -> dict:
        got = observed(self.observation)
        counts = {f: int(got.get(f, 0) or 0) for f in self.FIELDS}
        for side, n in enumerate(self.keyless, 1):
            counts[f"n{side}"] += n
            counts[f"only_{side}"] += n > 0  # all of them are one unmatched key
        return counts


def merge_unique(
    scores_1: DataFrame,
    scores_2: DataFrame,
    model_1: str = "model_1",
    model_2: str = "model_2",
    run_id: str | None = None,
    ensemble: Ensemble = mean_ensemble,
    now=None,
    key: str = KEY_COLUMN,
    metrics: MergeMetrics | None = None,
    clustered: bool = False,
) -> DataFrame:
    """The merge for inputs whose keys must be unique: one shuffle, no join.

    Both thin sides are unioned and grouped by key, and a key present on
    both sides yields one row - the same rows as the inner join when keys
    are unique.  Map-side partial aggregation collapses any heavy key
    (NULL included) to one row per task before the shuffle.  A non-NULL key
    seen twice on either side, matched or not, fails the job while it runs
    (``raise_error`` names the key), so duplicates never multiply rows; NULL
    keys never match.  ``metrics`` (a ``MergeMetrics``) receives the join-completeness
    counts of ``check_join`` from the same job.

    With ``clustered`` (both sides read bucket by bucket, see ``read_run_by_key``)
    each side is grouped by key and the two are joined, all without a shuffle; the
    rows, the failure on duplicates and the counts are the same.  Sides with
    different bucket counts are right as well: Spark shuffles what doesn't fit.
    """
    for side, name in ((scores_1, "first score set"), (scores_2, "second score set")):
        if key not in side.columns:
            raise ValueError(f"the {name} has no key column {key!r}")
    if model_1 == model_2:
        raise ValueError("the two models must have different names")
    s1n, t1n = score_column(model_1), timestamp_column(model_1)
    s2n, t2n = score_column(model_2), timestamp_column(model_2)
    left = score_view(scores_1, model_1, key)
    right = score_view(scores_2, model_2, key)
    grouped = (_grouped_joined if clustered else _grouped)(left, right, key, (s1n, t1n), (s2n, t2n))
    g, n1, n2 = F.col(KEY_COLUMN), F.col("_n1"), F.col("_n2")
    if metrics is not None:
        grouped = grouped.observe(
            metrics.observation,
            F.coalesce(F.sum(n1), F.lit(0)).cast("bigint").alias("n1"),
            F.coalesce(F.sum(n2), F.lit(0)).cast("bigint").alias("n2"),
            F.count_if(g.isNotNull() & (n1 > 0) & (n2 > 0)).alias("matched"),
            F.count_if((n1 > 0) & ((n2 == 0) | g.isNull())).alias("only_1"),
            F.count_if((n2 > 0) & ((n1 == 0) | g.isNull())).alias("only_2"),
            F.count_if(g.isNotNull() & ((n1 > 1) | (n2 > 1))).alias("dup_ids"),
            F.coalesce(F.sum(F.when(g.isNotNull(), n1 * n2)), F.lit(0)).cast("bigint")
            .alias("expected_rows"),
        )
    # The check is part of the filter, before the match is looked at: it sees
    # one-sided duplicates and runs whichever columns a caller selects.
    duplicate = F.raise_error(F.concat(F.lit("duplicate id in merge inputs: "), g)).cast("boolean")
    both = grouped.where(
        F.when(g.isNotNull() & ((n1 > 1) | (n2 > 1)), duplicate).otherwise(
            g.isNotNull() & (n1 > 0) & (n2 > 0)
        )
    )
    s1, s2 = F.col(s1n), F.col(s2n)
    cols = [
        g,
        s1.alias(s1n),
        s2,
        ensemble([s1, s2]).alias("ensemble_score"),
        F.col(t1n),
        F.col(t2n),
        as_timestamp(now).alias("merge_timestamp"),
    ]
    if run_id is not None:
        cols.append(F.lit(check_run_id(run_id)).alias(RUN_COLUMN))
    return both.select(cols)


def _grouped(left: DataFrame, right: DataFrame, key: str, of_1, of_2) -> DataFrame:
    """Each key once, with its rows on each side and their values: one grouping of the union."""
    (s1n, t1n), (s2n, t2n) = of_1, of_2
    t1type, t2type = left.schema[t1n].dataType, right.schema[t2n].dataType
    k = F.col(key)
    tagged = left.select(
        k.alias(KEY_COLUMN), F.lit(1).alias("_side"), F.col(s1n), F.col(t1n),
        F.lit(None).cast("double").alias(s2n), F.lit(None).cast(t2type).alias(t2n),
    ).unionByName(right.select(
        k.alias(KEY_COLUMN), F.lit(2).alias("_side"),
        F.lit(None).cast("double").alias(s1n), F.lit(None).cast(t1type).alias(t1n),
        F.col(s2n), F.col(t2n),
    ))
    # Each side contributes at most one row to a key that is kept (more fail
    # later), so max() picks that row's value: one fixed-width buffer per
    # column, where first(ignorenulls) needs two.
    return tagged.groupBy(KEY_COLUMN).agg(
        F.count_if(F.col("_side") == 1).alias("_n1"),
        F.count_if(F.col("_side") == 2).alias("_n2"),
        F.max(s1n).alias(s1n),
        F.max(t1n).alias(t1n),
        F.max(s2n).alias(s2n),
        F.max(t2n).alias(t2n),
    )


def _grouped_joined(left: DataFrame, right: DataFrame, key: str, of_1, of_2) -> DataFrame:
    """The same from one grouping per side and a full join of the two: bucketed sides
    keep their partitioning through both, so neither needs an exchange.  (A union
    of them loses it.)"""

    def one(side: DataFrame, n: str, names) -> DataFrame:
        values = [F.max(c).alias(c) for c in names]
        return side.groupBy(F.col(key).alias(KEY_COLUMN)).agg(F.count(F.lit(1)).alias(n), *values)

    both = one(left, "_n1", of_1).join(one(right, "_n2", of_2), KEY_COLUMN, "full")
    return both.withColumns({n: F.coalesce(F.col(n), F.lit(0)) for n in ("_n1", "_n2")})


def unmatched(
    scores_1: DataFrame,
    scores_2: DataFrame,
    names: tuple[str, str] = ("model_1", "model_2"),
    key: str = KEY_COLUMN,
) -> DataFrame:
    """(id, missing_from, copies): every key without a partner on the other side.

    One shuffle of the two key columns, tagged by side and counted before it,
    so a heavy key (NULL included) is one row per task.  ``copies`` is how many
    rows have the key.  A NULL key never matches: it is missing from each
    side that the other has it on.
    """
    tagged = scores_1.select(F.col(key).alias(KEY_COLUMN), F.lit(1).alias("_side")).unionByName(
        scores_2.select(F.col(key).alias(KEY_COLUMN), F.lit(2).alias("_side"))
    )
    per_key = tagged.groupBy(KEY_COLUMN).agg(
        F.count_if(F.col("_side") == 1).alias("_n1"), F.count_if(F.col("_side") == 2).alias("_n2")
    )
    k, n1, n2 = F.col(KEY_COLUMN), F.col("_n1"), F.col("_n2")
    sides = F.array(
        F.struct(F.lit(names[1]).alias("missing_from"), F.when(k.isNull() | (n2 == 0), n1).otherwise(0).alias("copies")),
        F.struct(F.lit(names[0]).alias("missing_from"), F.when(k.isNull() | (n1 == 0), n2).otherwise(0).alias("copies")),
    )
    return per_key.select(KEY_COLUMN, F.inline(sides)).where(F.col("copies") > 0)
