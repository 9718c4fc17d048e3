"""The scoring workload expressed over the driver's TPC-H-like tables.

* features: one row per order (``orders``), key ``id``; a total price under
  ``MIN_PRICE`` is outside the models' input range and counts as missing, so
  ``f_price`` is NULL there and NULL predictions occur (about 2% of orders);
* model 1: linear, over all orders; model 2: logistic, through the pandas-UDF
  path, over all of ``lineitem`` grouped by order.  A few orders have no line
  items, so the merge is incomplete by itself;
* registry: ``part`` read as (brand = name, type = stage, size = version);
* runs: ``events.ts`` truncated to the day.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewell.functions.columns import run_id_of
from scorewell.functions.models import LinearModel, PythonModel
from scorewell.operators.drift import Grid
from scorewell.sources.features import read_features

# Model weights (powers of two), pinned clock and run ids used
# by the checked queries.
MODEL_1 = LinearModel.of(
    "model_1", {"f_price": 0.0009765625, "f_priority": 0.5, "f_month": 0.25}
)
MODEL_2_LINEAR = LinearModel.of(
    "model_2",
    {"f_price": 0.00000762939453125, "f_priority": -0.25, "f_month": 0.125},
    link="logistic",
)
MODEL_2 = MODEL_2_LINEAR.as_python()
NOW = "2026-01-01 12:00:00"
RUN = "20260101_120000"
RUN_B = "20260102_120000"
# Fixed value: the models' valid price range starts here.
MIN_PRICE = 10000.0
# Another version of model 1, for a second run over the same features.
MODEL_1_NEXT = LinearModel.of(
    "model_1", {"f_price": 0.001953125, "f_priority": 0.25, "f_month": 0.5}
)


def _mixed(pdf):
    """A model with a text input: price and the number that the priority starts with."""
    return pdf["f_price"] * 0.0009765625 + pdf["priority"].str[:1].astype("float64") * 0.5


MODEL_MIXED = PythonModel("model_mixed", _mixed, features=("f_price", "priority"))


def _half_lost(pdf):
    """A model that gives no score to orders with an odd number of line items."""
    return (pdf["f_price"] * 0.00000762939453125).where(pdf["f_priority"] % 2 == 0)


# A version of model 2 that its checks refuse.
MODEL_2_REFUSED = PythonModel("model_2", _half_lost, features=("f_price", "f_priority"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_features(spark, f"{sf_dir.rstrip('/')}/orders.parquet", id_col="o_orderkey")
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderdate").alias("timestamp"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1)).otherwise(F.lit(0)).alias("label"),
        F.when(F.col("o_totalprice") < F.lit(MIN_PRICE), F.lit(None).cast("double"))
        .otherwise(F.col("o_totalprice"))
        .alias("f_price"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("f_priority"),
        F.month("o_orderdate").cast("double").alias("f_month"),
    )


def lineitem_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature set whose key repeats: (order, line number) is not unique."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("id"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_extendedprice").alias("f_price"),
        F.col("l_quantity").alias("f_priority"),
        F.month("l_shipdate").cast("double").alias("f_month"),
    )


def model_2_features(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """One row per order that has line items (of those that meet ``where``), from all of ``lineitem``.

    The aggregates are exact in any order of the rows (maximum, count, minimum).
    """
    price = F.max("l_extendedprice")
    lines = table(spark, sf_dir, "lineitem")
    return (
        (lines if where is None else lines.where(where)).groupBy("l_orderkey")
        .agg(
            F.min("l_shipdate").alias("timestamp"),
            F.when(price < F.lit(MIN_PRICE), F.lit(None).cast("double")).otherwise(price).alias("f_price"),
            F.count(F.lit(1)).cast("double").alias("f_priority"),
        )
        .select(
            F.col("l_orderkey").cast("string").alias("id"), "timestamp", "f_price", "f_priority",
            F.month("timestamp").cast("double").alias("f_month"),
        )
    )


def line_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model 2's logistic over single line items, keyed by order: many rows a key."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_extendedprice").alias("f_price"),
        F.col("l_quantity").alias("f_priority"),
        F.month("l_shipdate").cast("double").alias("f_month"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions as text, as a registry may store them."""
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("name"), F.col("p_type").alias("stage"),
        F.col("p_size").cast("string").alias("version"),
    )


# Bins of the two models' predictions (widths are powers of two).
DRIFT_GRIDS = (Grid("model_1_prediction", 0.0, 8.0, 64), Grid("model_2_prediction", 0.0, 0.03125, 32))
# Fixed value: an index that the yearly runs of a generated table may exceed.
DRIFT_MOST = 0.01


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry with times: every ``signup`` event is a new version of its user's model."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "signup")
    return ev.select(_model_name(), F.col("ts").alias("since"), F.col("event_id").cast("string").alias("version"))


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of those models: all other events."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") != "signup")
    return ev.select(F.col("event_id").alias("run"), _model_name(), F.col("ts").alias("at"))


def _model_name() -> Column:
    return F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("name")


def daily_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table, at): a daily run for each user on each day with an event of theirs."""
    day = F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("table"), day.alias("at"))


def model_2_json() -> bytes:
    """Model 2 as a model store may hold it."""
    return json.dumps({"weights": dict(MODEL_2_LINEAR.weights), "bias": MODEL_2_LINEAR.bias, "link": MODEL_2_LINEAR.link}).encode()


# Fixed value: orders before it are the older part of the evolved feature set.
OLDER = "1997-01-01"


def evolved_orders(spark: SparkSession, sf_dir: str, folder: str) -> list[str]:
    """All orders, written as two parts of different schemas."""
    o = table(spark, sf_dir, "orders")
    is_older = F.col("o_orderdate") < F.lit(OLDER).cast("timestamp_ntz")
    older = o.where(is_older).drop("o_orderpriority").withColumns({
        "o_custkey": F.col("o_custkey").cast("int"), "o_totalprice": F.col("o_totalprice").cast("float"),
        "o_clerk": F.concat(F.lit("clerk_"), F.col("o_custkey").cast("string")),
    })
    older.write.parquet(f"{folder}/older")
    o.where(~F.coalesce(is_older, F.lit(False))).write.parquet(f"{folder}/newer")
    return [f"{folder}/older", f"{folder}/newer"]


# Orders with a customer and line items, as their contract has them: ``discount`` isn't there.
NESTED_CONTRACT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("customer", T.StructType([T.StructField("key", T.LongType()), T.StructField("code", T.ByteType())])),
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("line", T.IntegerType()), T.StructField("tenths", T.ByteType()), T.StructField("discount", T.DoubleType())]))),
    T.StructField("flags", T.MapType(T.StringType(), T.ShortType())),
])


def nested_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as one row, its line items an array of structs and a map by line."""
    li = table(spark, sf_dir, "lineitem")
    tenths = (F.col("l_quantity") * 10).cast("bigint").cast("string")
    item = F.struct(F.col("l_linenumber").alias("line"), tenths.alias("tenths"), F.col("l_tax").alias("tax"))
    # An order has a handful of line items.
    lines = li.groupBy("l_orderkey").agg(F.collect_list(item).alias("items"))
    o = table(spark, sf_dir, "orders")
    return o.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.struct(F.col("o_custkey").alias("key"), F.substring("o_orderpriority", 1, 3).alias("code")).alias("customer"),
        "items",
        F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("customer"), F.col("o_custkey").cast("string")).alias("flags"),
    )


def event_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, level): a text column of tenths, some beyond what a TINYINT holds."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.regexp_extract("props", "([0-9]+)", 1), F.lit("0")).alias("level"),
    )


def event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    ts_type = ev.schema["ts"].dataType
    return ev.withColumn("run_id", run_id_of(F.date_trunc("day", F.col("ts")), ts_type))
