"""The schedule that runs are due on, and the runs that are missing from it.

The calendar is a spine of due moments, made where the tables are (``sequence``
and ``explode``, no join).  What is due and what is stored are laid over each
other in one grouping; moments that only the spine has are missing, and those in a
row form a gap: the moment less its rank among the missing ones is the same for
all of them.  The work grows with tables times moments, not with the runs' rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorewell.contracts import RUN_COLUMN
from scorewell.functions.columns import RUN_ID_FORMAT, as_timestamp
from scorewell.sources.catalog import run_counts


def _moment(value) -> Column:
    return as_timestamp(value).cast("timestamp_ntz")


def due_times(tables: DataFrame, first, last, every: dt.timedelta) -> DataFrame:
    """(table, due): for each row of ``tables`` all moments from ``first`` to ``last``, ``every`` so often.

    ``first`` and ``last`` are moments, or columns of ``tables``; a table whose
    first is after its last, or that lacks one, has none.
    """
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(every.total_seconds()))
    first, last = _moment(first), _moment(last)
    # sequence() refuses a step away from the end
    moments = F.when(first <= last, F.sequence(first, last, step))
    return tables.select("table", F.explode(moments).alias("due"))


def missing_runs(stored: DataFrame, tables: DataFrame, first, last, every: dt.timedelta = dt.timedelta(days=1)) -> DataFrame:
    """(table, due): what is due for ``tables`` (a column ``table``) and not in ``stored`` (table, at).

    ``stored`` may have any number of rows a run, and runs that aren't due (off the
    schedule, of other tables, without a time): they fill no gap.
    """
    due = due_times(tables.select("*").distinct(), first, last, every)
    have = stored.select("table", F.col("at").cast("timestamp_ntz").alias("due"), F.lit(False).alias("_due"))
    over = due.withColumn("_due", F.lit(True)).unionByName(have).groupBy("table", "due")
    marked = over.agg(F.max("_due").alias("_due"), F.min("_due").alias("_only"))
    return marked.where(F.col("_due") & F.col("_only")).select("table", "due")


def gaps(missing: DataFrame, every: dt.timedelta = dt.timedelta(days=1)) -> DataFrame:
    """(table, first, last, runs): missing runs in a row, from the first to the last of them."""
    rank = F.row_number().over(Window.partitionBy("table").orderBy("due"))
    # Wall-clock arithmetic: a day is a day, whatever the session's time zone does.
    before = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), rank * F.lit(every.total_seconds()))
    islands = missing.withColumn("_island", F.col("due") - before).groupBy("table", "_island")
    return islands.agg(F.min("due").alias("first"), F.max("due").alias("last"), F.count(F.lit(1)).alias("runs")).drop("_island")


def run_moment(run_id: Column) -> Column:
    """The moment that a run id stands for; NULL for ids of other forms."""
    return F.try_to_timestamp(run_id, F.lit(RUN_ID_FORMAT)).cast("timestamp_ntz")


def missing_of_tables(
    spark: SparkSession, tables: Mapping[str, str], first, last, every: dt.timedelta = dt.timedelta(days=1)
) -> DataFrame:
    """(table, due, run_id) of the runs that the stored ``tables`` (name -> table) lack, as stored now."""
    stored = run_counts(spark, tables).select("table", run_moment(F.col(RUN_COLUMN)).alias("at"))
    names = spark.createDataFrame([(n,) for n in tables], "table string")
    return missing_runs(stored, names, first, last, every).withColumn(RUN_COLUMN, F.date_format("due", RUN_ID_FORMAT))
