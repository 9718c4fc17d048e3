"""Models kept as bytes in a table."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewell.functions.models import LinearModel
from scorewell.functions.stored import fetch_model, store_model, stored_model
from scorewell.operators.score import score
from scorewell.plans.jobs import score_job
from scorewell.sources.catalog import read_run

URI = "models:/model_1/1"


def spec(weight):
    return json.dumps({"weights": {"x": weight, "y": -1.0}, "bias": 0.5}).encode()


def feats(spark, n=40, parts=8):
    return spark.range(n).select(F.col("id").cast("string").alias("id"), (F.col("id") * 1.5).alias("x"), F.col("id").cast("double").alias("y")).repartition(parts)


def test_stored_model_scores_as_the_model_itself(spark, db):
    t = f"{db}.models"
    store_model(spark, t, URI, spec(0.25))
    store_model(spark, t, "models:/model_1/2", spec(9.0))
    model = stored_model(spark.table(t), URI, "model_1", features=("x", "y"))
    own = LinearModel.of("model_1", {"x": 0.25, "y": -1.0}, bias=0.5)
    f = feats(spark)
    got, want = ({r["id"]: r["model_1_prediction"] for r in score(f, m).collect()} for m in (model, own))
    assert got == want
    assert score_job(spark, model, f, db, "model_1_scores", "r1").rows == 40 and read_run(spark, f"{db}.model_1_scores", "r1").count() == 40


def test_a_worker_loads_the_model_once_for_all_its_tasks(spark, db, tmp_path):
    t, log = f"{db}.models", str(tmp_path / "loads")
    store_model(spark, t, URI, b"2.0")

    def loads(payload):
        with open(log, "a") as f:
            f.write(f"{os.getpid()}\n")
        return float(payload)

    def predict(factor, pdf):
        with open(log + "-tasks", "a") as f:
            f.write(f"{os.getpid()}\n")
        return pdf["x"] * factor

    model = stored_model(spark.table(t), URI, "m", features=("x",), loads=loads, predict=predict)
    f = feats(spark, 64, 32)
    for _ in range(2):  # two jobs, 32 tasks each, all of them with rows
        assert score(f, model).agg(F.sum("m_prediction")).first()[0] == 2 * 1.5 * 64 * 63 / 2
    loaded, batches = open(log).read().split(), open(log + "-tasks").read().split()
    assert len(loaded) == len(set(loaded)) and set(loaded) == set(batches)
    assert len(loaded) <= spark.sparkContext.defaultParallelism < len(batches)


def test_the_bytes_are_not_in_the_plan_or_the_closure(spark, db):
    t, big = f"{db}.models", os.urandom(3 << 20)
    store_model(spark, t, URI, big)
    model = stored_model(spark.table(t), URI, "m", features=("x",), loads=len, predict=lambda n, pdf: np.full(len(pdf), float(n)))
    from pyspark import cloudpickle

    assert score(feats(spark, 3), model).first()["m_prediction"] == len(big)
    held = model.loader.__closure__
    assert not any(isinstance(c.cell_contents, (bytes, bytearray)) for c in held)
    assert len(cloudpickle.dumps(model.predict)) < 10_000


def test_a_uri_names_one_model(spark, db):
    t = f"{db}.models"
    first = store_model(spark, t, URI, spec(1.0))
    assert store_model(spark, t, URI, spec(1.0)) == first and spark.table(t).count() == 1
    with pytest.raises(ValueError, match="another model"):
        store_model(spark, t, URI, spec(2.0))
    with pytest.raises(ValueError, match="0 models under 'models:/none/1'"):
        fetch_model(spark.table(t), "models:/none/1")
    with pytest.raises(ValueError, match="more than 5"):
        fetch_model(spark.table(t), URI, largest=5)
    # copies of one row, as a retried append may leave, are one model
    assert fetch_model(spark.table(t).union(spark.table(t)), URI) == spec(1.0)
    damaged = spark.table(t).withColumn("payload", F.lit(bytearray(b"x")))
    with pytest.raises(ValueError, match="damaged"):
        fetch_model(damaged, URI)
    assert fetch_model(spark.table(t).withColumn("extra", F.lit(1)), URI) == spec(1.0)
