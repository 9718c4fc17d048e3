"""What became of each step of each run, as append-only rows.

A row says that a step of a run started, or ended as done, refused (by its
checks) or failed, with its rows and the version of the model that made them.
Rows are only ever added; a step's state is its latest row, found by a grouped
``max_by``, so no reader needs the rows in order, and a step that is repeated
many times reaches the shuffle as one row per task.

Skipping, resuming and status read this table alone; they don't look into the
run tables.  What a step stored but didn't get to record counts as not done, and
is stored again, which is harmless as runs are replaced whole.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewell.contracts import RUN_COLUMN, check_run_id
from scorewell.session import unique_name
from scorewell.sources.catalog import ensure_table, read_run, refresh_run, refresh_runs, table_exists

STATUSES = ("started", "done", "refused", "failed")


def ledger_contract() -> T.StructType:
    return T.StructType([
        T.StructField("step", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("version", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("at", T.TimestampNTZType()),
        T.StructField(RUN_COLUMN, T.StringType()),
    ])


@dataclass(frozen=True)
class Event:
    """``status`` of ``step``: rows it stored, the model's version, and a word on why."""

    step: str
    status: str
    rows: int | None = None
    version: str | None = None
    detail: str | None = None

    def __post_init__(self):
        if self.status not in STATUSES:
            raise ValueError(f"unknown status {self.status!r}; expected one of {STATUSES}")


_LAST = [dt.datetime.min]
_LOCK = threading.Lock()


def _moments(n: int) -> list[dt.datetime]:
    """``n`` ascending moments (UTC), later than all given before in this process."""
    with _LOCK:
        first = max(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), _LAST[0] + dt.timedelta(microseconds=1))
        out = [first + dt.timedelta(microseconds=k) for k in range(n)]
        _LAST[0] = out[-1] if out else _LAST[0]
    return out


class Ledger:
    """The ledger in ``table``, which the first record creates."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table

    def record(self, run_id: str, events: Iterable[Event]) -> None:
        """Adds the events, in their order, as one file of the run."""
        check_run_id(run_id)
        events = list(events)
        if not events:
            return
        ensure_table(self.spark, self.table, ledger_contract())
        rows = [(e.step, e.status, e.rows, e.version, e.detail, at, run_id) for e, at in zip(events, _moments(len(events)))]
        view = unique_name("_scorewell_events")
        self.spark.createDataFrame(rows, ledger_contract()).coalesce(1).createOrReplaceTempView(view)
        try:
            self.spark.sql(f"INSERT INTO {self.table} BY NAME SELECT * FROM `{view}`")
        finally:
            self.spark.catalog.dropTempView(view)

    def events(self, run_id: str | None = None) -> DataFrame:
        """All rows (of one run), as stored now."""
        if not table_exists(self.spark, self.table):
            return self.spark.createDataFrame([], ledger_contract())
        if run_id is None:
            refresh_runs(self.spark, self.table)
            return self.spark.table(self.table)
        refresh_run(self.spark, self.table, run_id)
        return read_run(self.spark, self.table, run_id)

    def latest(self, run_id: str | None = None) -> DataFrame:
        """Per run and step: status, rows, version, detail and time of the latest row, and the number of rows.

        Of rows with the same time, as clocks of two processes may give, the
        largest counts, column by column.
        """
        return latest_states(self.events(run_id))

    def states(self, run_id: str) -> dict[str, dict]:
        """{step: its latest row} of one run: a handful of steps."""
        return {r["step"]: r.asDict() for r in self.latest(run_id).collect()}

    def status(self, steps: Iterable[str]) -> DataFrame:
        """One row per run, one column per step: its status, NULL if it never began."""
        return self.latest().groupBy(RUN_COLUMN).pivot("step", list(steps)).agg(F.first("status"))

    def unfinished(self) -> DataFrame:
        """(run_id, step, status) of all steps that aren't done: what a resumed run has to do."""
        return self.latest().where(F.col("status") != "done").select(RUN_COLUMN, "step", "status")


def latest_states(events: DataFrame) -> DataFrame:
    """``Ledger.latest`` over any rows of the ledger's columns."""
    fields = ("status", "rows", "version", "detail")
    row = F.max_by(F.struct(*fields, "at"), F.struct("at", *fields)).alias("_row")
    got = events.groupBy(RUN_COLUMN, "step").agg(row, F.count(F.lit(1)).alias("events"))
    return got.select(RUN_COLUMN, "step", *[F.col(f"_row.{c}").alias(c) for c in (*fields, "at")], "events")
