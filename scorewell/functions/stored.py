"""Models kept as bytes in a table, fetched by URI.

The table has a row per model version: its URI, the bytes of the model, and their
SHA-256.  Scoring fetches the one row, checks the digest, and hands the bytes to the
executors as a broadcast value: they travel once to each executor, outside the
tasks' closures.  A Python worker turns them into a model once and keeps it, for all
batches of all tasks that it runs with this model.

A model passes through the driver's memory, so its size is checked before it is
fetched: ``largest`` bytes, 256 MB by default.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from hashlib import sha256
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewell.functions.models import PythonModel, _linear_predictor
from scorewell.session import unique_name
from scorewell.sources.catalog import _split, table_exists

try:  # As in ``models``: workers need not have this package.
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the API
    pass

LARGEST = 256 << 20


def store_contract() -> T.StructType:
    return T.StructType([
        T.StructField("uri", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("sha256", T.StringType()),
    ])


def store_model(spark: SparkSession, table: str, uri: str, payload: bytes) -> str:
    """Adds a model's bytes under ``uri``; returns their digest.

    A URI names one model for good: storing the same bytes again adds nothing,
    other bytes under a URI that is taken are refused.
    """
    _split(table)
    digest = sha256(payload).hexdigest()
    if table_exists(spark, table):
        spark.catalog.refreshTable(table)
        taken = {r["sha256"] for r in spark.table(table).where(F.col("uri") == F.lit(uri)).select("sha256").distinct().collect()}
        if taken == {digest}:
            return digest
        if taken:
            raise ValueError(f"{table} has another model under {uri!r}")
    else:
        spark.createDataFrame([], store_contract()).write.format("parquet").saveAsTable(table)
    view = unique_name("_scorewell_model")
    spark.createDataFrame([(uri, bytearray(payload), digest)], store_contract()).coalesce(1).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT INTO {table} BY NAME SELECT * FROM `{view}`")
    finally:
        spark.catalog.dropTempView(view)
    return digest


def fetch_model(models: DataFrame, uri: str, largest: int = LARGEST) -> bytes:
    """The bytes under ``uri``: the size is looked at first, the digest after."""
    mine = models.where(F.col("uri") == F.lit(uri))
    found = mine.agg(F.count_distinct("sha256").alias("n"), F.max(F.octet_length("payload")).alias("size"), F.max("sha256").alias("sha256")).first()
    if found["n"] != 1:
        raise ValueError(f"there are {found['n']} models under {uri!r}; expected one")
    if found["size"] > largest:
        raise ValueError(f"the model under {uri!r} has {found['size']} bytes, more than {largest}")
    payload = bytes(mine.select("payload").first()["payload"])
    if sha256(payload).hexdigest() != found["sha256"]:
        raise ValueError(f"the model under {uri!r} is damaged: its digest differs")
    return payload


def linear_from_json(payload: bytes) -> Callable:
    """The predictor of ``{"weights": {...}, "bias": 0.0, "link": "identity"}``."""
    spec = json.loads(payload)
    return _linear_predictor(tuple(spec["weights"].items()), spec.get("bias", 0.0), spec.get("link", "identity"))


def apply_model(model: Callable, pdf) -> Any:
    return model(pdf)


def stored_model(
    models: DataFrame,
    uri: str,
    name: str,
    features: tuple[str, ...] | None = None,
    loads: Callable[[bytes], Any] = linear_from_json,
    predict: Callable[[Any, Any], Any] = apply_model,
    largest: int = LARGEST,
) -> PythonModel:
    """The model stored under ``uri`` as a ``PythonModel`` of this ``name``.

    ``loads`` makes a model of the bytes, ``predict(model, pdf)`` scores a batch.
    """
    held = models.sparkSession.sparkContext.broadcast(fetch_model(models, uri, largest))

    def load():
        # A worker has one object per broadcast value, for all its tasks.
        kept = held.__dict__
        if "_scorewell_model" not in kept:
            kept["_scorewell_model"] = loads(held.value)
        return kept["_scorewell_model"]

    return PythonModel(name, predict, features=features, loader=load)
