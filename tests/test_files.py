"""Output file sizing of the map-only score write: with more input splits
than task slots the write rebalances (AQE sizes the partitions), so a run is
not left as one small file per split; without the rebalance it is.

The driver's tables are one Parquet row group each (one non-empty split), so
the features are first written as several files to get several splits.
"""

from pyspark.sql import functions as F

from scorewell.plans import fixtures as fx
from scorewell.plans.jobs import score_job
from scorewell.session import scratch_location
from scorewell.sources.catalog import read_run
from scorewell.sources.features import read_features
from tests.conftest import SF_ORACLE


def files_of(spark, table, run_id):
    return read_run(spark, table, run_id).select(F.input_file_name()).distinct().count()


def test_score_write_files_follow_the_rebalance(spark, db):
    path = scratch_location(spark, "split_features")
    slots = spark.sparkContext.defaultParallelism
    fx.features(spark, SF_ORACLE).repartition(slots + 4).write.parquet(path)
    # Small files are packed into one split by their open cost; make each
    # file its own split, as large files are at scale.
    key = "spark.sql.files.openCostInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "1k")
    try:
        f = read_features(spark, path)
        splits = f.rdd.getNumPartitions()
        assert splits == slots + 4
        runs = {"on": True, "off": False}
        for name, rebalance in runs.items():
            res = score_job(spark, fx.MODEL_1, f, db, f"scores_{name}", "r1", now=fx.NOW,
                            rebalance=rebalance)
            assert res.rows == 15000
    finally:
        spark.conf.set(key, old)
    t = {name: f"{db}.scores_{name}" for name in runs}
    assert files_of(spark, t["off"], "r1") == splits
    assert files_of(spark, t["on"], "r1") < splits
    for name in runs:
        assert read_run(spark, t[name], "r1").count() == 15000
