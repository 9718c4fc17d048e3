"""Model registry as a table: (name, stage, version) -> latest version and URI.

The registry is data, not a service: a DataFrame (or catalog table) with
one row per registered model version.  The latest version per
(name, stage) is a grouped ``max``; resolving one model collects one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewell.functions.columns import as_timestamp
from scorewell.operators.asof import as_of

# Fixed value: the model URI form.
URI_PREFIX = "models:/"


def model_uri(name, version) -> F.Column:
    return F.concat(F.lit(URI_PREFIX), name, F.lit("/"), version.cast("string"))


def latest_versions(
    registry: DataFrame, name: str = "name", stage: str = "stage", version: str = "version"
) -> DataFrame:
    """The whole registry row with the highest version per (name, stage), and its ``model_uri``.

    Versions are ordered as numbers, also where they are stored as text; text
    that is no number comes before all numbers.  Of rows with the same version
    the largest, column by column, counts.
    """
    renamed = registry.withColumnsRenamed({name: "name", stage: "stage", version: "version"})
    number = F.col("version").try_cast("decimal(38,0)")
    rest = [c for c in renamed.columns if c not in ("name", "stage", "version")]
    latest = renamed.groupBy("name", "stage").agg(
        F.max(F.struct(number.alias("_number"), F.col("version"), *rest)).alias("_row")
    )
    return latest.select("name", "stage", *[F.col(f"_row.{c}").alias(c) for c in ("version", *rest)]).withColumn(
        "model_uri", model_uri(F.col("name"), F.col("version"))
    )


def resolve(registry: DataFrame, model_name: str, model_stage: str, **cols) -> tuple[str, object]:
    """(uri, version) of the latest version; error naming both if none."""
    rows = (
        latest_versions(registry, **cols)
        .where((F.col("name") == F.lit(model_name)) & (F.col("stage") == F.lit(model_stage)))
        .select("model_uri", "version")
        .collect()
    )
    if not rows:
        raise ValueError(f"the registry has no version of {model_name!r} at stage {model_stage!r}")
    return rows[0]["model_uri"], rows[0]["version"]


def versions_at(runs: DataFrame, registry: DataFrame, at: str = "at", since: str = "since", slices: int = 64) -> DataFrame:
    """``runs`` (name, ``at``, ...) with the version that was current then, and its URI.

    Current is the version of the name that was registered last, at ``since``, by
    then; of versions registered at the same time the highest (as numbers, where
    they are).  A run before its model's first version has NULLs.
    """
    number = F.col("version").try_cast("decimal(38,0)")
    known = registry.select("name", since, number.alias("_number"), F.col("version").alias("version"))
    found = as_of(runs, known, ["name"], at, since, ["_number", "version"], slices).drop("_number")
    return found.withColumn("model_uri", model_uri(F.col("name"), F.col("version")))


def resolve_at(registry: DataFrame, model_name: str, moment, since: str = "since") -> tuple[str, object]:
    """(uri, version) of the version that was current at ``moment``; error if there was none."""
    run = registry.sparkSession.createDataFrame([(model_name,)], "name string").withColumn("at", as_timestamp(moment).cast("timestamp_ntz"))
    mine = registry.where(F.col("name") == F.lit(model_name)).withColumn(since, F.col(since).cast("timestamp_ntz"))
    row = versions_at(run, mine, since=since, slices=1).first()
    if row["version"] is None:
        raise ValueError(f"the registry has no version of {model_name!r} at {moment}")
    return row["model_uri"], row["version"]
