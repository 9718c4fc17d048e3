"""Run-partitioned catalog tables: create, write one run, read one run, status.

Write semantics (the part that is easy to get wrong):

* a run is one partition ``run_id = <value>`` of a Parquet table;
* ``write_run`` replaces exactly that partition with a *dynamic* partition
  overwrite whose ``run_id`` is a constant column: the old rows go only when
  the new ones are committed, so a job that fails leaves the run as it was.
  An empty frame has no partition to replace; it clears the run afterwards;
* the frame must carry exactly the contract's data columns (Spark alone
  would fill a missing column with NULL);
* the row count comes from an ``Observation`` on the write itself, not a
  second job;
* ``write_runs`` is the multi-run (backfill) form: a dynamic partition
  overwrite that replaces only the runs present in the frame.

A run is "done" when its partition holds at least one row.  Looking a run up
changes nothing that is stored, and sees what other processes have written: the
run's folder is looked for first, and registered with this session's catalog
only if it is there.
"""

from __future__ import annotations

from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from scorewell.contracts import (
    KEY_COLUMN,
    RUN_COLUMN,
    RUN_ID_PATTERN,
    check_identifier,
    check_run_id,
    column_ddl,
    data_columns,
)
from scorewell.session import unique_name


def _sql_string(value: str, what: str) -> str:
    if "'" in value or "\\" in value:
        raise ValueError(f"{what} may not contain quotes or backslashes: {value!r}")
    return f"'{value}'"


def qualified(database: str, table: str) -> str:
    return f"{check_identifier(database, 'database')}.{check_identifier(table, 'table')}"


def _split(table: str) -> tuple[str | None, str]:
    parts = table.split(".")
    if len(parts) == 1:
        return None, check_identifier(parts[0], "table")
    if len(parts) == 2:
        return check_identifier(parts[0], "database"), check_identifier(parts[1], "table")
    raise ValueError(f"expected [database.]table, got {table!r}")


def _quoted(table: str) -> str:
    db, name = _split(table)
    return f"`{db}`.`{name}`" if db else f"`{name}`"


# --- K1 / K2: database and contract table -------------------------------------------


def ensure_database(
    spark: SparkSession, database: str, location: str | None = None, comment: str | None = None
) -> None:
    sql = f"CREATE DATABASE IF NOT EXISTS `{check_identifier(database, 'database')}`"
    if comment:
        sql += f" COMMENT {_sql_string(comment, 'comment')}"
    if location:
        sql += f" LOCATION {_sql_string(location, 'location')}"
    spark.sql(sql)


def ensure_table(
    spark: SparkSession,
    table: str,
    contract: T.StructType,
    location: str | None = None,
    partition: str = RUN_COLUMN,
) -> None:
    """Create the Parquet/Snappy table partitioned by run, or check the existing one.

    The table always gets an explicit location (default: under its
    database's location), so a later process with its own catalog session
    can declare it again over the same files and see every earlier run.
    """
    if table_exists(spark, table):
        have = {f.name: f.dataType for f in spark.table(table).schema.fields}
        want = {f.name: f.dataType for f in contract.fields}
        if have != want:
            raise ValueError(f"table {table} exists with schema {have}, expected {want}")
        return
    if partition not in {f.name for f in contract.fields}:
        raise ValueError(f"contract has no partition column {partition!r}")
    if location is None:
        db, name = _split(table)
        db_uri = spark.catalog.getDatabase(db or spark.catalog.currentDatabase()).locationUri
        location = f"{db_uri.rstrip('/')}/{name}"
    sql = (
        f"CREATE TABLE IF NOT EXISTS {_quoted(table)} ({column_ddl(contract)}) USING parquet "
        "OPTIONS ('compression' = 'snappy', 'partitionOverwriteMode' = 'dynamic') "
        f"PARTITIONED BY (`{partition}`)"
    )
    if location:
        sql += f" LOCATION {_sql_string(location, 'location')}"
    spark.sql(sql)
    # Register runs already on storage (written by an earlier process); the
    # catalog tracks partitions, so a fresh declaration starts with none.
    refresh_runs(spark, table)


# --- K7 / A1 / R1: existence, rows of a run, "done" ---------------------------------------


def table_exists(spark: SparkSession, table: str) -> bool:
    _split(table)
    return spark.catalog.tableExists(table)


def read_run(spark: SparkSession, table: str, run_id: str) -> DataFrame:
    """One run's rows; ``run_id`` stays a bare column so the partition is pruned."""
    check_run_id(run_id)
    return spark.table(table).where(F.col(RUN_COLUMN) == F.lit(run_id))


def run_rows(spark: SparkSession, table: str, run_id: str) -> int:
    """Rows of a run as stored now; 0 if the table or the run doesn't exist."""
    check_run_id(run_id)
    if not table_exists(spark, table) or not refresh_run(spark, table, run_id):
        return 0
    return read_run(spark, table, run_id).count()


def table_location(spark: SparkSession, table: str) -> str:
    """The URI of a table's folder."""
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").collect():
        if row["col_name"] == "Location":
            return row["data_type"].rstrip("/")
    raise ValueError(f"table {table} has no location")


def run_folder(spark: SparkSession, table: str, run_id: str) -> str:
    return f"{table_location(spark, table)}/{RUN_COLUMN}={check_run_id(run_id)}"


def _path(spark: SparkSession, uri: str):
    """(Hadoop path, its file system)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def refresh_run(spark: SparkSession, table: str, run_id: str) -> bool:
    """See one run of an existing table as it is stored now; is its folder there?

    Another process may have written the run since this session declared the
    table: if its folder is there, its partition is registered (that one, not
    the whole table) and cached file listings are dropped.  If it isn't, nothing
    is registered or created.
    """
    path, fs = _path(spark, run_folder(spark, table, run_id))
    there = fs.exists(path)
    if there:
        spark.sql(f"ALTER TABLE {_quoted(table)} ADD IF NOT EXISTS PARTITION (`{RUN_COLUMN}` = '{run_id}')")
    spark.catalog.refreshTable(table)
    return there


def refresh_runs(spark: SparkSession, table: str) -> None:
    """See all runs of an existing table as they are stored now."""
    # A table without a run has no folder yet.
    path, fs = _path(spark, table_location(spark, table))
    if fs.exists(path):
        spark.sql(f"ALTER TABLE {_quoted(table)} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table)


def run_exists(spark: SparkSession, table: str, run_id: str) -> bool:
    """Done = the table exists and the run's partition, as stored now, has a row.

    Only a missing table or folder means "not done"; any other error propagates.
    """
    if not table_exists(spark, table) or not refresh_run(spark, table, run_id):
        return False
    return not read_run(spark, table, run_id).isEmpty()


def require_rows(df: DataFrame, what: str) -> None:
    """Raise, naming the input, if ``df`` has no rows (reads at most one row)."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")


def require_columns(df: DataFrame, columns, what: str = "input") -> None:
    have = set(df.columns)
    missing = [c for c in columns if c not in have]
    if missing:
        raise ValueError(f"column(s) {missing} not found in {what}")


# --- K3-K6: writes --------------------------------------------------------------------


def _observed_rows(obs: Observation, df: DataFrame) -> int:
    """Rows counted by the write's own observation.

    When the optimizer proves the input empty it removes the observed node
    and no metrics arrive; only then do we count (a no-op plan).
    """
    got = observed(obs)
    return int(got["rows"]) if "rows" in got else df.count()


def observed(obs: Observation) -> dict:
    """The metrics of a finished job; empty if its plan lost the observed node."""
    try:
        return dict(obs.get)
    except Py4JJavaError as e:
        if "PythonSQLUtils.toPyRow" not in str(e):  # how an empty metrics row fails
            raise
        return {}


def _check_frame(df: DataFrame, expected: list[str], table: str) -> None:
    have = list(df.columns)
    missing = [c for c in expected if c not in have]
    extra = [c for c in have if c not in expected]
    if missing or extra:
        raise ValueError(
            f"frame does not match the contract of {table}: missing {missing}, extra {extra}"
        )


def write_run(
    df: DataFrame,
    table: str,
    run_id: str,
    contract: T.StructType | None = None,
    location: str | None = None,
    rebalance: bool = False,
    buckets: int | None = None,
    dealt: bool = False,
) -> int:
    """Replace run ``run_id`` of ``table`` with ``df``; return the rows written.

    Creates the table from ``contract`` on first use.  ``rebalance`` adds an
    AQE ``REBALANCE`` before the write, for inputs of many small splits.  If
    the job fails, the run keeps the rows that it had.

    With ``buckets`` the run's files are clustered by the key into so many
    buckets (see ``read_run_by_key``), at the price of one shuffle of the rows
    by key here; with ``dealt`` without one, for rows that lie by bucket already
    (a scan of a feature set clustered alike): if they don't, buckets have many
    files, but the same rows.
    """
    spark = df.sparkSession
    check_run_id(run_id)
    if buckets is not None and (buckets < 1 or rebalance):
        raise ValueError("a run has one bucket or more, and buckets already size its files: no rebalance")
    if contract is not None:
        ensure_table(spark, table, contract, location=location)
    elif not table_exists(spark, table):
        raise ValueError(f"table {table} does not exist and no contract was given")
    target = spark.table(table).schema
    _check_frame(df, data_columns(target), table)

    obs = Observation(unique_name("rows"))
    if rebalance:
        df = df.hint("rebalance")
    # Observed in the writing stage (above any rebalance exchange): counted
    # once even when a lost executor forces an earlier stage to re-run.
    if buckets is not None and not dealt:
        df = _dealt_by_key(df, buckets)
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    _overwrite(counted.withColumn(RUN_COLUMN, F.lit(run_id)), table if buckets is None else _by_key(spark, table, buckets))
    rows = _observed_rows(obs, df)
    if rows == 0:
        clear_run(spark, table, run_id)
    elif buckets is not None:
        # Only now, so that a run without the mark is never taken for a bucketed one.
        path, fs = _path(spark, f"{run_folder(spark, table, run_id)}/{BUCKET_MARK}{buckets}")
        fs.create(path, True).close()
        refresh_run(spark, table, run_id)
    return rows


# --- runs whose files are clustered by the key ------------------------------------------------

#: A file of this name and the number of buckets lies in the folder of a bucketed run;
#: readers skip it for its underscore, and replacing the run replaces it.
BUCKET_MARK = "_buckets-"


def _by_key(spark: SparkSession, table: str, buckets: int) -> str:
    """The table's files declared once more, as clustered by the key.

    The bucket count belongs to a table's declaration, but runs of one table may
    be written with different ones.  So the table itself has none (any read of it
    is right whatever its runs' buckets), and each count has a declaration of its
    own over the same files, through which only runs written so are read.
    """
    db, name = _split(table)
    twin = f"{name}_by_{KEY_COLUMN}_{int(buckets)}"
    twin = f"{db}.{twin}" if db else twin
    if not table_exists(spark, twin):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_quoted(twin)} ({column_ddl(spark.table(table).schema)}) USING parquet "
            "OPTIONS ('compression' = 'snappy', 'partitionOverwriteMode' = 'dynamic') "
            f"PARTITIONED BY (`{RUN_COLUMN}`) CLUSTERED BY (`{KEY_COLUMN}`) INTO {int(buckets)} BUCKETS "
            f"LOCATION {_sql_string(table_location(spark, table), 'location')}"
        )
    return twin


def _dealt_by_key(df: DataFrame, buckets: int) -> DataFrame:
    """One shuffle that brings each bucket's rows to one task, and so to one file.

    Rows without a key belong to one bucket, but match nothing; they are dealt
    over all tasks, so that many of them make many files, not one long task.
    """
    key = F.coalesce(F.col(KEY_COLUMN), F.rand(1).cast("string"))
    return df.repartition(buckets, key)


def run_buckets(spark: SparkSession, table: str, run_id: str) -> int | None:
    """The number of buckets that the stored run was written with; None if it wasn't."""
    path, fs = _path(spark, run_folder(spark, table, run_id))
    if not fs.exists(path):
        return None
    marks = [f.getPath().getName() for f in fs.listStatus(path)]
    found = [int(m[len(BUCKET_MARK):]) for m in marks if m.startswith(BUCKET_MARK)]
    return found[0] if len(found) == 1 else None


def read_run_by_key(spark: SparkSession, table: str, run_id: str) -> DataFrame:
    """One run, read bucket by bucket if it was written so: grouping by the key, or
    joining with a run of as many buckets, then needs no shuffle.  Other runs are
    read as ``read_run`` does, and shuffled by what needs their keys together."""
    buckets = run_buckets(spark, table, run_id)
    if buckets is None:
        return read_run(spark, table, run_id)
    twin = _by_key(spark, table, buckets)
    refresh_run(spark, twin, run_id)
    return read_run(spark, twin, run_id)


def clear_run(spark: SparkSession, table: str, run_id: str) -> None:
    """Leave the run's partition without rows."""
    columns = ", ".join(
        f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in spark.table(table).schema.fields if f.name != RUN_COLUMN
    )
    spark.sql(
        f"INSERT OVERWRITE {_quoted(table)} PARTITION (`{RUN_COLUMN}` = '{check_run_id(run_id)}') "
        f"BY NAME SELECT {columns} WHERE false"
    )


def _overwrite(df: DataFrame, table: str) -> None:
    """Replace the partitions present in ``df`` (the table's option
    partitionOverwriteMode=dynamic), at commit and not before."""
    view = unique_name("_scorewell_write")
    df.createOrReplaceTempView(view)
    try:
        df.sparkSession.sql(
            f"INSERT OVERWRITE {_quoted(table)} PARTITION (`{RUN_COLUMN}`) "
            f"BY NAME SELECT * FROM `{view}`"
        )
    finally:
        df.sparkSession.catalog.dropTempView(view)


def write_runs(df: DataFrame, table: str, contract: T.StructType | None = None,
               location: str | None = None) -> int:
    """Backfill: replace every run present in ``df`` (which carries ``run_id``).

    A NULL or malformed run id fails the job, and no run is replaced.
    """
    spark = df.sparkSession
    if contract is not None:
        ensure_table(spark, table, contract, location=location)
    target = spark.table(table).schema
    _check_frame(df, [f.name for f in target.fields], table)
    obs = Observation(unique_name("rows"))
    # Cluster files by run; AQE splits a heavy run into advisory-size parts.
    run = F.col(RUN_COLUMN)
    sound = F.when(run.rlike(f"^(?:{RUN_ID_PATTERN})\\z"), run).otherwise(
        F.raise_error(F.concat(F.lit("invalid run_id: "), F.coalesce(run, F.lit("NULL"))))
    )
    df = df.withColumn(RUN_COLUMN, sound)
    _overwrite(
        df.hint("rebalance", RUN_COLUMN).observe(obs, F.count(F.lit(1)).alias("rows")), table
    )
    return _observed_rows(obs, df)


# --- R3: status of all runs -----------------------------------------------------------


def run_counts(spark: SparkSession, tables: Mapping[str, DataFrame | str]) -> DataFrame:
    """Long form: (run_id, table, rows) over every run of every table, as stored now.

    Counting rows needs no data columns, so Parquet answers from footers.
    """
    parts = []
    for name, src in tables.items():
        if isinstance(src, str):
            refresh_runs(spark, src)
        df = spark.table(src) if isinstance(src, str) else src
        parts.append(
            df.groupBy(RUN_COLUMN)
            .agg(F.count(F.lit(1)).alias("rows"))
            .select(F.col(RUN_COLUMN), F.lit(name).alias("table"), F.col("rows"))
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_status(spark: SparkSession, tables: Mapping[str, DataFrame | str]) -> DataFrame:
    """Wide form: one row per run, one rows-column per table (NULL = run absent)."""
    names = list(tables)
    return (
        run_counts(spark, tables)
        .groupBy(RUN_COLUMN)
        .pivot("table", names)
        .agg(F.sum("rows"))
    )


def drop_table(spark: SparkSession, table: str) -> None:
    try:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(table)}")
    except AnalysisException:
        pass
