"""Validation of a run: row counts, schema, nulls, join completeness,
ensemble validity, quality metrics, and the gate over all of them.

Every check is one aggregation over the data (partial aggregation on the
map side, so a hot key collapses to one row per task) followed by a JVM-side
reshape into check rows - one SQL ``stack`` over the one-row aggregate,
however many checks there are::

    check STRING, metric STRING, value DOUBLE, threshold DOUBLE, passed BOOLEAN

Only the gate brings rows to the driver, and only failing check rows
(a handful, bounded by the number of checks).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewell.contracts import (
    KEY_COLUMN,
    RUN_COLUMN,
    check_run_id,
    prediction_column,
    score_column,
)
from scorewell.functions.columns import Ensemble, mean_ensemble

CHECK_COLUMNS = ["check", "metric", "value", "threshold", "passed"]
QUALITY_METRICS = ("rows", "nulls", "min", "max", "mean", "stddev")


# A check row as SQL over a one-row frame of aggregates:
# (check, metric, value, threshold, passed).  ``threshold`` is a SQL
# expression (str), a number, or None for NULL.
CheckRow = tuple


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _number(value) -> str:
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    if isinstance(value, str):
        return value
    return f"CAST({float(value)!r} AS DOUBLE)"


def _stack(one_row: DataFrame, rows: Sequence[CheckRow]) -> DataFrame:
    """Check rows from a one-row frame of aggregates: a single ``stack``."""
    args = []
    for check, metric, value, threshold, passed in rows:
        args += [_text(check), _text(metric), f"CAST({value} AS DOUBLE)",
                 f"CAST({_number(threshold)} AS DOUBLE)", f"CAST({passed} AS BOOLEAN)"]
    return one_row.selectExpr(
        f"stack({len(rows)}, {', '.join(args)}) AS (`check`, metric, value, threshold, passed)"
    )


def _with_expected(one_row: DataFrame, expected_rows) -> tuple[DataFrame, str | None]:
    """``expected_rows`` (a number or a scalar-subquery Column) as SQL."""
    if expected_rows is None:
        return one_row, None
    if isinstance(expected_rows, Column):
        return one_row.withColumn("_expected_rows", expected_rows), "`_expected_rows`"
    return one_row, str(int(expected_rows))


# --- V1 / V3 (+ key health) -------------------------------------------------------------


def check_scores(
    features: DataFrame,
    scores: DataFrame,
    model_name: str,
    max_null_fraction: float = 0.05,
    key: str = KEY_COLUMN,
    duplicates: bool = True,
    rows_in: int | None = None,
) -> DataFrame:
    """Rows scored vs rows in, NULL predictions, duplicate and NULL keys.

    ``rows_in``: how many features the scoring write read, if it counted them;
    else they are counted here.

    Without ``duplicates`` this is one scan with no shuffle (use it when the
    strict merge, which fails on a duplicate key, follows anyway).
    """
    pred = F.col(prediction_column(model_name))
    k = F.col(key)
    if duplicates:
        per_key = scores.groupBy(k.alias("k")).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(pred.isNull()).alias("nn")
        )
        agg = per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum("nn"), F.lit(0)).alias("nulls"),
            F.count_if(F.col("k").isNotNull() & (F.col("n") > 1)).alias("dups"),
            F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        )
    else:
        agg = scores.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(pred.isNull()).alias("nulls"),
            F.count_if(k.isNull()).alias("null_keys"),
        )
    # Without a count: a scalar subquery over the features, run with the check.
    given = features.select(F.count(F.lit(1))).scalar() if rows_in is None else F.lit(rows_in)
    agg = agg.withColumn("rows_in", given)
    frac = "CASE WHEN `rows` > 0 THEN `nulls` / `rows` ELSE 0.0 END"
    out = [
        ("row_count", "rows", "`rows`", "`rows_in`", "`rows` = `rows_in`"),
        ("null_predictions", "null_rows", "`nulls`", None, "true"),
        ("null_predictions", "null_fraction", frac, max_null_fraction,
         f"{frac} <= {_number(max_null_fraction)}"),
    ]
    if duplicates:
        out.append(("duplicate_ids", "ids", "`dups`", 0, "`dups` = 0"))
    out.append(("null_ids", "rows", "`null_keys`", 0, "`null_keys` = 0"))
    return _stack(agg, out)


def duplicate_keys(df: DataFrame, key: str = KEY_COLUMN) -> DataFrame:
    """(id, copies) for every non-NULL key present more than once.

    A grouped count with map-side partial aggregation: a heavy key reaches
    the shuffle as one row per task.
    """
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias(KEY_COLUMN))
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


# --- V2: schema against the contract ---------------------------------------------------------


def check_schema(
    df: DataFrame, contract: T.StructType, allow_extra: Sequence[str] = ()
) -> DataFrame:
    """(column, expected, actual, status, bad_values, passed) per column.

    status: ok (same type) | cast (other type, every value casts) |
    bad_values (some non-NULL values do not cast) | missing | unexpected |
    carried (extra column named in ``allow_extra``).  ``bad_values`` is
    counted over the data with ``try_cast`` in one aggregation.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    expected = {f.name: f.dataType for f in contract.fields}
    names = [f.name for f in contract.fields] + [c for c in df.columns if c not in expected]
    retyped = [n for n in names if n in expected and n in actual and expected[n] != actual[n]]
    if retyped:
        # One aggregation counts the values that do not cast to the contract.
        aggs = []
        for i, name in enumerate(retyped):
            c = F.col(_ident(name))
            aggs.append(F.count_if(c.isNotNull() & c.try_cast(expected[name]).isNull())
                        .alias(f"_bad_{i}"))
        base = df.agg(*aggs)
    else:
        # Same types throughout: the answer is in the schemas, no data is read.
        base = df.sparkSession.range(1)
    bad_col = {name: f"`_bad_{i}`" for i, name in enumerate(retyped)}

    def text(x):
        return "CAST(NULL AS STRING)" if x is None else _text(x)

    args = []
    for name in names:
        exp = expected[name].simpleString() if name in expected else None
        act = actual[name].simpleString() if name in actual else None
        if exp is None:
            status = "carried" if name in allow_extra else "unexpected"
            bad, ok, status_sql = "NULL", str(status == "carried").lower(), _text(status)
        elif act is None:
            bad, ok, status_sql = "NULL", "false", _text("missing")
        elif name in bad_col:
            bad = bad_col[name]
            ok = f"{bad} = 0"
            status_sql = f"CASE WHEN {bad} = 0 THEN 'cast' ELSE 'bad_values' END"
        else:
            bad, ok, status_sql = "0", "true", _text("ok")
        args += [_text(name), text(exp), text(act), status_sql, f"CAST({bad} AS BIGINT)",
                 f"CAST({ok} AS BOOLEAN)"]
    return base.selectExpr(
        f"stack({len(names)}, {', '.join(args)}) "
        "AS (`column`, expected, actual, status, bad_values, passed)"
    )


def schema_check_rows(schema_diff: DataFrame) -> DataFrame:
    """The schema check as check rows: one failing row per bad column."""
    return schema_diff.select(
        F.lit("schema").alias("check"),
        F.concat_ws(":", F.col("column"), F.col("status")).alias("metric"),
        F.col("bad_values").cast("double").alias("value"),
        F.lit(None).cast("double").alias("threshold"),
        F.col("passed"),
    )


# --- V4: join completeness --------------------------------------------------------------------


def check_join(scores_1: DataFrame, scores_2: DataFrame, key: str = KEY_COLUMN) -> DataFrame:
    """One row: n1, n2, matched, only_1, only_2, dup_ids, expected_rows.

    One shuffle of the two key columns (tagged by side) with map-side
    partial counts - no join, and a hot key collapses before the shuffle.
    ``expected_rows`` = sum over matched keys of n1 * n2 (the merge's size).
    A NULL key never matches, so it counts as unmatched on each side, and
    its rows are no duplicates.
    """
    tagged = scores_1.select(F.col(key).alias("k"), F.lit(1).alias("side")).unionByName(
        scores_2.select(F.col(key).alias("k"), F.lit(2).alias("side"))
    )
    per_key = tagged.groupBy("k").agg(
        F.count_if(F.col("side") == 1).alias("n1"), F.count_if(F.col("side") == 2).alias("n2")
    )
    k, n1, n2 = F.col("k"), F.col("n1"), F.col("n2")
    return per_key.agg(
        F.coalesce(F.sum(n1), F.lit(0)).cast("bigint").alias("n1"),
        F.coalesce(F.sum(n2), F.lit(0)).cast("bigint").alias("n2"),
        F.count_if(k.isNotNull() & (n1 > 0) & (n2 > 0)).alias("matched"),
        F.count_if((n1 > 0) & ((n2 == 0) | k.isNull())).alias("only_1"),
        F.count_if((n2 > 0) & ((n1 == 0) | k.isNull())).alias("only_2"),
        F.count_if(k.isNotNull() & ((n1 > 1) | (n2 > 1))).alias("dup_ids"),
        F.coalesce(F.sum(F.when(k.isNotNull(), n1 * n2)), F.lit(0)).cast("bigint")
        .alias("expected_rows"),
    )


def input_counts(scores_1: DataFrame, scores_2: DataFrame) -> DataFrame:
    """One row (n1, n2): the rows of each side; no data column is read."""
    sides = scores_1.select(F.lit(1).alias("side")).unionByName(scores_2.select(F.lit(2).alias("side")))
    return sides.agg(
        F.count_if(F.col("side") == 1).alias("n1"), F.count_if(F.col("side") == 2).alias("n2")
    )


def join_check_rows(join_counts: DataFrame, names=("model_1", "model_2")) -> DataFrame:
    return _stack(
        join_counts,
        [
            ("join_completeness", "matched", "matched", 1, "matched >= 1"),
            ("join_completeness", f"only_{names[0]}", "only_1", None, "true"),
            ("join_completeness", f"only_{names[1]}", "only_2", None, "true"),
            ("join_completeness", "duplicate_ids", "dup_ids", 0, "dup_ids = 0"),
        ],
    )


# --- V5: ensemble validity -----------------------------------------------------------------------


def _ensemble_aggs(model_1, model_2, ensemble, eps) -> list[Column]:
    s1, s2 = F.col(score_column(model_1)), F.col(score_column(model_2))
    e, rule = F.col("ensemble_score"), ensemble([s1, s2])
    # least and greatest skip NULL inputs: what a rule makes of the others lies between those.
    outside = (e < F.least(s1, s2) - F.lit(eps)) | (e > F.greatest(s1, s2) + F.lit(eps))
    ranged = getattr(ensemble, "within_inputs", False)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(e.isNull() != rule.isNull()).alias("null_mismatch"),
        F.count_if(e.isNotNull() & rule.isNotNull() & (e != rule) & (F.abs(e - rule) > F.lit(eps))).alias("rule_mismatch"),
        (F.count_if(e.isNotNull() & outside) if ranged else F.lit(None).cast("bigint")).alias("out_of_range"),
    ]


def check_ensemble(
    merged: DataFrame,
    model_1: str = "model_1",
    model_2: str = "model_2",
    ensemble: Ensemble = mean_ensemble,
    eps: float = 1e-9,
) -> DataFrame:
    """One row: rows, null_mismatch, rule_mismatch, out_of_range.

    What is right is the rule's to say, NULL inputs included:
    null_mismatch: ensemble NULL and rule(s1, s2) not, or the other way round.
    rule_mismatch: neither NULL, |ensemble - rule(s1, s2)| > eps.
    out_of_range: ensemble outside [min(s1, s2), max(s1, s2)] (+- eps), for rules
    marked ``within_inputs`` as the mean is; NULL, and passed, for others.
    """
    return merged.agg(*_ensemble_aggs(model_1, model_2, ensemble, eps))


def _ensemble_rows(expected: str | None = None) -> list[CheckRow]:
    rows = [
        ("ensemble", "null_mismatch", "null_mismatch", 0, "null_mismatch = 0"),
        ("ensemble", "rule_mismatch", "rule_mismatch", 0, "rule_mismatch = 0"),
        ("ensemble", "out_of_range", "out_of_range", 0, "coalesce(out_of_range, 0) = 0"),
    ]
    if expected is not None:
        rows.append(("join_completeness", "merged_rows", "`rows`", expected,
                     f"`rows` = {expected}"))
    return rows


def ensemble_check_rows(ens: DataFrame, expected_rows=None) -> DataFrame:
    ens, expected = _with_expected(ens, expected_rows)
    return _stack(ens, _ensemble_rows(expected))


# --- V6: quality metrics -------------------------------------------------------------------------


def _quality_aggs(columns: Sequence[str]) -> list[Column]:
    aggs = ["count(1) AS _rows"]
    for i, name in enumerate(columns):
        c = _ident(name)
        aggs += [
            f"count_if({c} IS NULL) AS _nulls_{i}",
            f"min({c}) AS _min_{i}",
            f"max({c}) AS _max_{i}",
            f"avg({c}) AS _mean_{i}",
            f"stddev({c}) AS _stddev_{i}",
        ]
    return [F.expr(a) for a in aggs]


def _quality_values(columns: Sequence[str], digits: int | None):
    """(column, metric, SQL value over the aggregates of ``_quality_aggs``)."""
    for i, name in enumerate(columns):
        for metric in QUALITY_METRICS:
            v = "_rows" if metric == "rows" else f"_{metric}_{i}"
            v = f"CAST({v} AS DOUBLE)"
            if digits is not None:
                v = f"round({v}, {int(digits)})"
            yield name, metric, v


def quality_metrics(df: DataFrame, columns: Sequence[str], digits: int | None = 6) -> DataFrame:
    """(column, metric, value) for rows, nulls, min, max, mean, stddev - one pass."""
    args = [a for name, metric, v in _quality_values(columns, digits)
            for a in (_text(name), _text(metric), v)]
    return df.agg(*_quality_aggs(columns)).selectExpr(
        f"stack({len(args) // 3}, {', '.join(args)}) AS (`column`, metric, value)"
    )


def merged_checks_one_pass(
    merged: DataFrame,
    model_1: str = "model_1",
    model_2: str = "model_2",
    ensemble: Ensemble = mean_ensemble,
    eps: float = 1e-9,
    expected_rows=None,
    digits: int | None = 6,
) -> DataFrame:
    """Ensemble validity (V5) and quality metrics (V6) as check rows from
    a single aggregation over the merged run."""
    cols = [score_column(model_1), score_column(model_2), "ensemble_score"]
    one = merged.agg(*_ensemble_aggs(model_1, model_2, ensemble, eps), *_quality_aggs(cols))
    one, expected = _with_expected(one, expected_rows)
    rows = _ensemble_rows(expected) + [
        ("quality", f"{name}.{metric}", v, None, "true")
        for name, metric, v in _quality_values(cols, digits)
    ]
    return _stack(one, rows)


def quality_check_rows(metrics: DataFrame) -> DataFrame:
    """Quality metrics as informational check rows (always pass)."""
    return metrics.select(
        F.lit("quality").alias("check"),
        F.concat_ws(".", F.col("column"), F.col("metric")).alias("metric"),
        F.col("value"),
        F.lit(None).cast("double").alias("threshold"),
        F.lit(True).alias("passed"),
    )


# --- V7: report and gate ---------------------------------------------------------------------------


def report(run_id: str, scope: str, *frames: DataFrame) -> DataFrame:
    """Union check rows with (run_id, scope) in front."""
    check_run_id(run_id)
    head = [f"{_text(run_id)} AS {_ident(RUN_COLUMN)}", f"{_text(scope)} AS scope"]
    head += [_ident(c) for c in CHECK_COLUMNS]
    out = None
    for f in frames:
        f = f.selectExpr(*head)
        out = f if out is None else out.unionByName(f)
    return out


class ValidationError(RuntimeError):
    def __init__(self, failures):
        self.failures = failures
        lines = [f"{r['scope']}/{r['check']}/{r['metric']}: value={r['value']} "
                 f"threshold={r['threshold']}" for r in failures]
        super().__init__("validation failed: " + "; ".join(lines))


def gate(checks: DataFrame) -> None:
    """Raise ValidationError listing all failed checks (bounded by the number of checks)."""
    failed = checks.where(~F.coalesce(F.col("passed"), F.lit(False))).collect()
    if failed:
        raise ValidationError([r.asDict() for r in failed])


def gate_rows(rows) -> None:
    """``gate`` over check rows already collected (a bounded list)."""
    failed = [r.asDict() for r in rows if not r["passed"]]
    if failed:
        raise ValidationError(failed)
