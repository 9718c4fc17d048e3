"""Output table contracts.

The score and merge tables have a fixed column set and types, Parquet with
Snappy, partitioned by the run id.  The prediction and score column names
carry the model name, so the contracts are built per model.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

RUN_COLUMN = "run_id"
KEY_COLUMN = "id"

# Metadata columns of a feature set: everything else is a model input.
FEATURE_METADATA = ("id", "timestamp", "label")

# Run ids are partition values: letters, digits, - and _ only.
RUN_ID_PATTERN = r"[A-Za-z0-9_\-]+"
_IDENT = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_RUN_ID = re.compile(RUN_ID_PATTERN)


def check_identifier(name: str, what: str = "identifier") -> str:
    if not isinstance(name, str) or not _IDENT.fullmatch(name):
        raise ValueError(f"invalid {what}: {name!r}")
    return name


def check_run_id(run_id: str) -> str:
    """Run ids are partition values; refuse anything but [A-Za-z0-9_-]."""
    if not isinstance(run_id, str) or not _RUN_ID.fullmatch(run_id):
        raise ValueError(f"invalid run_id: {run_id!r}")
    return run_id


def prediction_column(model_name: str) -> str:
    return f"{check_identifier(model_name, 'model name')}_prediction"


def score_column(model_name: str) -> str:
    return f"{check_identifier(model_name, 'model name')}_score"


def timestamp_column(model_name: str) -> str:
    return f"{check_identifier(model_name, 'model name')}_timestamp"


def score_contract(model_name: str) -> T.StructType:
    """``model_K_scores``: id, prediction, scoring time, model name | run_id."""
    return T.StructType(
        [
            T.StructField(KEY_COLUMN, T.StringType()),
            T.StructField(prediction_column(model_name), T.DoubleType()),
            T.StructField("scoring_timestamp", T.TimestampType()),
            T.StructField("model_name", T.StringType()),
            T.StructField(RUN_COLUMN, T.StringType()),
        ]
    )


def merged_contract(model_1: str = "model_1", model_2: str = "model_2") -> T.StructType:
    """``merged_model_scores``: id, both scores, ensemble, three times | run_id."""
    return T.StructType(
        [
            T.StructField(KEY_COLUMN, T.StringType()),
            T.StructField(score_column(model_1), T.DoubleType()),
            T.StructField(score_column(model_2), T.DoubleType()),
            T.StructField("ensemble_score", T.DoubleType()),
            T.StructField(timestamp_column(model_1), T.TimestampType()),
            T.StructField(timestamp_column(model_2), T.TimestampType()),
            T.StructField("merge_timestamp", T.TimestampType()),
            T.StructField(RUN_COLUMN, T.StringType()),
        ]
    )


def data_columns(contract: T.StructType, partition: str = RUN_COLUMN) -> list[str]:
    return [f.name for f in contract.fields if f.name != partition]


def column_ddl(contract: T.StructType) -> str:
    """``id STRING, ...`` for CREATE TABLE (names are checked identifiers)."""
    parts = []
    for field in contract.fields:
        check_identifier(field.name, "column name")
        parts.append(f"`{field.name}` {field.dataType.simpleString().upper()}")
    return ", ".join(parts)
