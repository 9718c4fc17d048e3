"""Scoring: prediction column, metadata stamp, projection to the table contract.

Scoring is a narrow, map-only transformation: no shuffle, one output row
per input row, parallel over the input splits.  Filters placed on the
features before ``score`` run below the model and reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewell.contracts import (
    KEY_COLUMN,
    RUN_COLUMN,
    check_run_id,
    prediction_column,
)
from scorewell.functions.columns import as_timestamp


def score(df: DataFrame, model) -> DataFrame:
    """Add ``{model.name}_prediction`` (DOUBLE, NaN stored as NULL)."""
    return df.withColumn(prediction_column(model.name), model.column(df))


def stamp(df: DataFrame, model_name: str, run_id: str | None = None, now=None) -> DataFrame:
    """Add scoring time, model name and (optionally) run id.

    ``now=None`` uses ``current_timestamp()`` - one value per query, so all
    rows of a run share one stamp.  Pass a value to pin it.
    """
    cols = {"scoring_timestamp": as_timestamp(now), "model_name": F.lit(model_name)}
    if run_id is not None:
        cols[RUN_COLUMN] = F.lit(check_run_id(run_id))
    return df.withColumns(cols)


def score_frame(
    features: DataFrame,
    model,
    run_id: str | None = None,
    now=None,
    key: str = KEY_COLUMN,
    carry_columns: tuple[str, ...] = (),
) -> DataFrame:
    """Features -> the score table's columns (id as STRING, prediction, stamp).

    Only the key, the model's inputs and ``carry_columns`` are read from the
    feature set, so the scan prunes every other column.
    """
    if key not in features.columns:
        raise ValueError(f"key column {key!r} not found in features")
    scored = stamp(score(features, model), model.name, run_id, now)
    cols = [F.col(key).cast("string").alias(KEY_COLUMN), F.col(prediction_column(model.name))]
    cols += [F.col("scoring_timestamp"), F.col("model_name")]
    cols += [F.col(c) for c in carry_columns]
    if run_id is not None:
        cols.append(F.col(RUN_COLUMN))
    return scored.select(cols)


def score_many(features: DataFrame, models, key: str = KEY_COLUMN) -> DataFrame:
    """All models' predictions from one scan: (id, m1_prediction, m2_prediction, ...)."""
    cols = [F.col(key).cast("string").alias(KEY_COLUMN)]
    cols += [m.column(features).alias(prediction_column(m.name)) for m in models]
    return features.select(cols)
