"""Feature sets: Parquet data with an ``id`` key column.

``id`` is the row key, ``timestamp`` and ``label`` are optional metadata and
every other column is a model input.  The scan is lazy: column pruning and
filters put on the result reach the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_features(
    spark: SparkSession,
    path: str | list[str],
    id_col: str = "id",
    decimals_to_double: bool = True,
) -> DataFrame:
    """Read a Parquet feature set; the key column must be present.

    DECIMAL columns become DOUBLE (float models cannot take DECIMAL
    batches); the key is left as read and cast to STRING on scoring.
    """
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    if id_col not in df.columns:
        raise ValueError(f"feature set {paths}: key column {id_col!r} not found")
    if decimals_to_double:
        df = doubles_for_decimals(df)
    return df


def doubles_for_decimals(df: DataFrame) -> DataFrame:
    if not any(isinstance(f.dataType, T.DecimalType) for f in df.schema.fields):
        return df
    return df.select(
        [
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
