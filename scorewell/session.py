"""Session construction and the shared scratch location.

Tables written by checked queries, tests and benchmarks live under the
cluster's shared checkpoint folder (``spark.checkpoint.dir``).  We read
that setting from the session and only set our own when it is unset
(local tests), never falling back to a machine-local folder silently on a
cluster that names one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every scorewell session wants; the values are sized for a
# laptop or CI box and are overridable by the caller.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on sizes measured at run time (AQE, after a shuffle map
    # stage), never on the planner's estimate from compressed file sizes.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# What every session that isn't local gets besides (e.g. 1000 executors,
# ~100 TB of features), again only where the submitted conf leaves it unset:
# many shuffle partitions, which AQE coalesces to the advisory size, and larger
# input splits for the map-only scoring stage.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64MB",
    "spark.sql.files.maxPartitionBytes": "512MB",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def get_session(
    master: str | None = None,
    app_name: str = "scorewell",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the scorewell defaults.

    Explicit ``conf`` / ``shuffle_partitions`` always apply.  The SQL
    defaults of ``DEFAULT_CONF`` are set on the session only where the
    context's conf (spark-submit, spark-defaults) leaves them unset.
    """
    explicit = dict(conf or {})
    if shuffle_partitions is not None:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in explicit.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    submitted = spark.sparkContext.getConf()
    cluster = {} if spark.sparkContext.master.startswith("local") else CLUSTER_CONF
    for key, value in (DEFAULT_CONF | cluster).items():
        if key.startswith("spark.sql.") and key not in explicit and not submitted.contains(key):
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Order: the context's checkpoint dir, then ``spark.checkpoint.dir`` from
    the session conf.  Only a local-mode session (tests) with neither set
    gets a private temporary folder; on a cluster that would be one
    machine's disk, so there it is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
            "spark.checkpoint.dir", None
        )
        if not root:
            if not sc.master.startswith("local"):
                raise ValueError(
                    "spark.checkpoint.dir is not set: set it to a folder shared by the cluster"
                )
            root = tempfile.mkdtemp(prefix="scorewell-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_location(spark: SparkSession, label: str) -> str:
    """A fresh, unique sub-folder of the checkpoint root for one use."""
    safe = "".join(ch if ch.isalnum() or ch in "_-" else "_" for ch in label)
    return f"{checkpoint_root(spark)}/scorewell/{safe}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession) -> bool:
    """Deletes all scratch folders of this application; were there any?

    For callers that have stored what they want elsewhere: frames that read a
    scratch folder (results of the corpus operators, tables of checked queries)
    can't be read after it.  The checkpoint folder's other contents stay.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/scorewell")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unique_name(prefix: str) -> str:
    """A catalog-safe unique identifier (database or view name)."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"
