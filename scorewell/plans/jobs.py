"""Jobs: score one model into its run partition, merge two score sets of a
run, and the whole run (score both, validate each, merge, validate).

State passes between steps only through the run-partitioned tables and the
run id, as between separate processes: each step reads its inputs back from
the catalog, so a step that is retried (or a lost executor) recomputes only
from durable tables, never from a long lineage.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewell.contracts import (
    KEY_COLUMN,
    check_run_id,
    merged_contract,
    score_contract,
    timestamp_column,
)
from scorewell.functions.columns import Ensemble, mean_ensemble
from scorewell.operators.checks import (
    check_join,
    check_schema,
    check_scores,
    gate_rows,
    join_check_rows,
    merged_checks_one_pass,
    report,
    schema_check_rows,
)
from scorewell.operators.drift import DriftCheck, drift_check_rows, drift_of_run, store_histograms
from scorewell.operators.merge import MergeMetrics, merge_scores, merge_unique
from scorewell.operators.score import score_frame
from scorewell.sources.catalog import (
    ensure_database,
    ensure_table,
    observed,
    qualified,
    read_run,
    read_run_by_key,
    refresh_run,
    require_rows,
    run_buckets,
    run_exists,
    table_exists,
    write_run,
)
from scorewell.session import unique_name
from scorewell.sources.ledger import Event, Ledger
from scorewell.sources.features import read_features

MERGED_TABLE = "merged_model_scores"
REPORT_TABLE = "validation_report"
LEDGER_TABLE = "run_ledger"


@dataclass
class JobResult:
    table: str
    run_id: str
    rows: int | None
    skipped: bool
    details: dict = field(default_factory=dict)


def _features(spark: SparkSession, features) -> DataFrame:
    return features if isinstance(features, DataFrame) else read_features(spark, features)


def counted_features(features: DataFrame, model, rows_in: Observation) -> DataFrame:
    """The features that the model and the key need, counted as they are read."""
    if (names := getattr(model, "features", None)) is not None:
        features = features.select(KEY_COLUMN, *[F.col(f"`{n}`") for n in names if n in features.columns])
    return features.observe(rows_in, F.count(F.lit(1)).alias("rows"))


def score_job(
    spark: SparkSession,
    model,
    features: DataFrame | str,
    database: str,
    table: str,
    run_id: str,
    now=None,
    force: bool = False,
    location: str | None = None,
    rebalance: bool = False,
    buckets: int | None = None,
    dealt: bool = False,
) -> JobResult:
    """Score ``features`` with ``model`` into ``database.table``, run ``run_id``.

    Skips when the run is already done (unless ``force``).  The scoring
    itself is map-only and leaves one file per input split; ``rebalance``
    adds a shuffle of the thin score rows that sizes the files, for feature
    sets of many small splits.  ``buckets`` clusters the run's files by key, so that
    the merge needs no shuffle (see ``write_run``; ``dealt`` for features that are
    clustered alike).  ``details['rows_in']`` is the number of
    feature rows that the writing job read.  A failed run keeps what the table had.
    """
    check_run_id(run_id)
    target = qualified(database, table)
    contract = score_contract(model.name)
    # Declare the table first (over its files, if an earlier process wrote
    # them) so "done" is judged on every run already stored.
    ensure_database(spark, database, location=location)
    ensure_table(spark, target, contract)
    if not force and run_exists(spark, target, run_id):
        return JobResult(target, run_id, None, True)
    rows_in = Observation(unique_name("rows_in"))
    frame = score_frame(counted_features(_features(spark, features), model, rows_in), model, now=now)
    frame = frame.withColumn("scoring_timestamp", F.col("scoring_timestamp").cast("timestamp"))
    # The table was declared above; the write checks the frame against it.
    rows = write_run(frame, target, run_id, rebalance=rebalance, buckets=buckets, dealt=dealt)
    return JobResult(target, run_id, rows, False, {"rows_in": observed(rows_in).get("rows")})


def merge_job(
    spark: SparkSession,
    database: str,
    run_id: str,
    model_1: str = "model_1",
    model_2: str = "model_2",
    tables: tuple[str, str, str] | None = None,
    ensemble: Ensemble = mean_ensemble,
    now=None,
    force: bool = False,
    strict: bool = True,
    location: str | None = None,
    most_rows: int | None = None,
) -> JobResult:
    """Read both score sets of the run, join on ``id``, write the merged run.

    Guards: the merged run is skipped when done; both inputs must have rows,
    which is looked at before any work (the error names table and run); in
    ``strict`` mode (one shuffle, see ``merge_unique``) a duplicate key on
    either side fails the write job, so nothing is committed and an earlier
    merged run stays, and ``details['join']`` holds the join-completeness
    counts observed by the same job.  If both runs are stored in buckets by key,
    the strict merge reads them bucket by bucket and shuffles nothing.  Without
    ``strict`` the join runs, and
    ``details['join']`` holds the same counts from one aggregation before it;
    a join that would have more than ``most_rows`` rows is refused.
    """
    check_run_id(run_id)
    t1, t2, tm = tables or (f"{model_1}_scores", f"{model_2}_scores", MERGED_TABLE)
    t1, t2, tm = (qualified(database, t) for t in (t1, t2, tm))
    ensure_database(spark, database, location=location)
    for t, contract in ((t1, score_contract(model_1)), (t2, score_contract(model_2)),
                        (tm, merged_contract(model_1, model_2))):
        ensure_table(spark, t, contract)
    if not force and run_exists(spark, tm, run_id):
        return JobResult(tm, run_id, None, True)
    sides = []
    for t in (t1, t2):
        refresh_run(spark, t, run_id)
        sides.append(read_run(spark, t, run_id))
        require_rows(sides[-1], f"{t}, run {run_id},")
    s1, s2 = sides
    details = {}
    metrics = None
    if strict:
        # One shuffle: the merge itself fails on a duplicate key and reports
        # the join-completeness counts as observations of the same job.
        metrics = MergeMetrics()
        clustered = all(run_buckets(spark, t, run_id) for t in (t1, t2))
        if clustered:
            # Rows without a key match nothing, but lie in one bucket: they are
            # counted file by file and left out of the reading by bucket.
            metrics.keyless = tuple(s.where(F.col(KEY_COLUMN).isNull()).count() for s in sides)
            s1, s2 = (read_run_by_key(spark, t, run_id).where(F.col(KEY_COLUMN).isNotNull()) for t in (t1, t2))
        merged = merge_unique(s1, s2, model_1, model_2, ensemble=ensemble, now=now,
                              metrics=metrics, clustered=clustered)
    else:
        # Before the join, one aggregation of the keys (no join) gives the
        # join-completeness counts; ``expected_rows`` is the size the join
        # will have (n1 * n2 per key).
        counts = check_join(s1, s2).first().asDict()
        details["join"] = counts
        if most_rows is not None and counts["expected_rows"] > most_rows:
            raise ValueError(
                f"the join of run {run_id} would have {counts['expected_rows']} rows, more than {most_rows}"
            )
        merged = merge_scores(s1, s2, model_1, model_2, ensemble=ensemble, now=now)
    merged = merged.withColumns(
        {
            c: F.col(c).cast("timestamp")
            for c in (timestamp_column(model_1), timestamp_column(model_2), "merge_timestamp")
        }
    )
    try:
        rows = write_run(merged, tm, run_id)  # declared above with its contract
    except PySparkException as e:
        if "duplicate id in merge inputs" in str(e):
            raise ValueError(
                f"duplicate id(s) in the inputs of run {run_id} ({t1}, {t2}); the join would "
                "multiply rows (pass strict=False to allow)"
            ) from e
        raise
    if metrics is not None:
        details["join"] = metrics.get()
    return JobResult(tm, run_id, rows, False, details)


@dataclass
class ModelRun:
    """One model of a run: the model, its feature set, its score table."""

    model: object
    features: DataFrame | str
    table: str | None = None
    #: The registered version that the model is, for the ledger.
    version: str | None = None

    @property
    def table_name(self) -> str:
        return self.table or f"{self.model.name}_scores"


@dataclass
class PipelineConfig:
    database: str
    models: tuple[ModelRun, ModelRun]
    merged_table: str = MERGED_TABLE
    report_table: str | None = REPORT_TABLE
    #: Where steps are recorded (see ``sources.ledger``), e.g. ``LEDGER_TABLE``.
    ledger_table: str | None = None
    #: Compares the merged scores with the run before, and gates it.
    drift: DriftCheck | None = None
    ensemble: Ensemble = mean_ensemble
    location: str | None = None
    strict: bool = True
    max_null_fraction: float = 0.05
    eps: float = 1e-9
    parallel: bool = True


@dataclass
class PipelineResult:
    run_id: str
    jobs: list[JobResult]
    report: DataFrame
    merged: DataFrame


def run_pipeline(
    spark: SparkSession, cfg: PipelineConfig, run_id: str, now=None, force: bool = False
) -> PipelineResult:
    """Score each model -> validate each -> merge -> validate merged -> gate.

    Check rows are computed once (one job per stage; they are a bounded
    handful, so they are collected for the gate) and, when ``report_table``
    is set, stored in that table's run partition, before the gate raises
    ``ValidationError``: a run that is refused, or that fails, leaves the rows of
    all checks that were made, and one for the step that failed.

    Steps that are done are skipped.  A model whose checks were refused isn't
    done: the next call scores it again, and merges again.  With ``ledger_table``
    what is done is read from the ledger alone, and each step is recorded there.
    """
    check_run_id(run_id)
    db = cfg.database
    ensure_database(spark, db, location=cfg.location)
    ledger = Ledger(spark, qualified(db, cfg.ledger_table)) if cfg.ledger_table else None
    states = {} if ledger is None else ledger.states(run_id)
    # Scopes (models, or the merged run) that their checks refused before.
    refused = _refused_before(spark, cfg, run_id) if ledger is None else {
        step.removeprefix("check ") for step, s in states.items() if s["status"] == "refused"}

    def note(*events: Event) -> None:
        if ledger is not None:
            ledger.record(run_id, events)

    def is_done(step: str) -> bool:
        return states.get(step, {}).get("status") == "done"

    note(Event("run", "started"))

    def branch(mr: ModelRun):
        name, target = mr.model.name, qualified(db, mr.table_name)
        again = force or name in refused
        if ledger is not None and not again and is_done(f"score {name}"):
            job = JobResult(target, run_id, None, True)
            ensure_table(spark, target, score_contract(name))
            refresh_run(spark, target, run_id)
        else:
            job = score_job(spark, mr.model, mr.features, db, mr.table_name, run_id, now=now,
                            force=again or ledger is not None)
        scores = read_run(spark, target, run_id)
        # In strict mode the merge itself fails on a duplicate key, so the
        # per-model check needs no shuffle.
        checks = check_scores(_features(spark, mr.features), scores, name,
                              max_null_fraction=cfg.max_null_fraction,
                              duplicates=not cfg.strict, rows_in=job.details.get("rows_in"))
        # The stored run against its contract (V2): read from the schemas.
        schema = schema_check_rows(check_schema(scores, score_contract(name)))
        # Check rows are a bounded handful.
        return job, report(run_id, name, checks, schema).collect()

    # The two models' branches are independent (as in the reference's
    # schedule): their jobs run concurrently on the cluster.
    m1, m2 = cfg.models
    with ThreadPoolExecutor(max_workers=2 if cfg.parallel else 1, thread_name_prefix="scorewell") as pool:
        futures = [pool.submit(branch, m) for m in cfg.models]
    jobs, rows, events, error = [], [], [], None
    for mr, future in zip(cfg.models, futures):
        name, error_of = mr.model.name, future.exception()
        if error_of is not None:
            error = error or error_of
            rows.append(_failed_row(run_id, name, "score_job"))
            events.append(Event(f"score {name}", "failed", version=mr.version, detail=_why(error_of)))
            continue
        job, checks = future.result()
        jobs.append(job)
        rows += checks
        if not job.skipped:
            events.append(Event(f"score {name}", "done", job.rows, mr.version))
        events.append(_judged(f"check {name}", checks, mr.version))
    refuses = not all(r["passed"] for r in rows)
    if refuses:
        events.append(Event("run", "refused" if error is None else "failed"))
    note(*events)
    if refuses:
        _store_report(spark, cfg, run_id, rows)
        if error is not None:
            raise error
        gate_rows(rows)

    n1, n2 = m1.model.name, m2.model.name
    tables = (m1.table_name, m2.table_name, cfg.merged_table)
    # A merged run that its gate refused, or that is older than this run's
    # scores, isn't done.
    stale = any(not j.skipped for j in jobs) or "merged" in refused or (ledger is not None and not is_done("merge"))
    try:
        merge = merge_job(spark, db, run_id, n1, n2, tables=tables, ensemble=cfg.ensemble,
                          now=now, force=force or stale, strict=cfg.strict)
    except Exception as e:
        note(Event("merge", "failed", detail=_why(e)), Event("run", "failed"))
        _store_report(spark, cfg, run_id, [*rows, _failed_row(run_id, "merged", "merge_job")])
        raise
    jobs.append(merge)

    s1, s2, merged = (read_run(spark, qualified(db, t), run_id) for t in tables)
    merged_rows = report(run_id, "merged", *merged_check_frames(
        s1, s2, merged, n1, n2, cfg.ensemble, cfg.eps, join_counts=merge.details.get("join"))).collect()
    if cfg.drift is not None:
        counts = qualified(db, cfg.drift.table)
        store_histograms(merged, cfg.drift.grids, counts, run_id)
        found = drift_of_run(spark, counts, run_id, cfg.drift.grids, cfg.drift.most)
        merged_rows += report(run_id, "merged", drift_check_rows(found, cfg.drift.most)).collect()
    judged = _judged("check merged", merged_rows)
    note(*([] if merge.skipped else [Event("merge", "done", merge.rows)]), judged,
         Event("run", judged.status, merge.rows))
    full = _store_report(spark, cfg, run_id, rows + merged_rows)
    gate_rows(merged_rows)
    return PipelineResult(run_id, jobs, full, merged)


def _why(error: BaseException) -> str:
    """The first line of an error, for the ledger."""
    return f"{type(error).__name__}: {str(error).strip().splitlines()[0] if str(error).strip() else ''}"[:500]


def _judged(step: str, rows, version: str | None = None) -> Event:
    failed = [f"{r['check']}/{r['metric']}" for r in rows if not r["passed"]]
    return Event(step, "refused" if failed else "done", version=version, detail=", ".join(failed)[:500] or None)


def _failed_row(run_id: str, scope: str, step: str) -> Row:
    """A failing check row that stands for a step that raised."""
    values = (run_id, scope, step, "error", None, None, False)
    return Row(**dict(zip(report_schema().names, values)))


def _store_report(spark: SparkSession, cfg: PipelineConfig, run_id: str, rows) -> DataFrame:
    """The check rows as a frame, stored as the run's report if the run has one."""
    full = spark.createDataFrame(rows, schema=report_schema())
    if cfg.report_table:
        write_run(full.drop("run_id"), qualified(cfg.database, cfg.report_table), run_id,
                  contract=report_contract())
    return full


def _refused_before(spark: SparkSession, cfg: PipelineConfig, run_id: str) -> set[str]:
    """The scopes of the run's stored report that have a failed check: three at most."""
    if not cfg.report_table:
        return set()
    table = qualified(cfg.database, cfg.report_table)
    if not table_exists(spark, table) or not refresh_run(spark, table, run_id):
        return set()
    failed = read_run(spark, table, run_id).where(~F.coalesce(F.col("passed"), F.lit(False)))
    return {r["scope"] for r in failed.select("scope").distinct().collect()}


def merged_check_frames(s1, s2, merged, n1="model_1", n2="model_2", ensemble=mean_ensemble,
                        eps=1e-9, join_counts: dict | None = None) -> list[DataFrame]:
    """V4 (join completeness), then V5 (ensemble validity + row count) and V6
    (quality) from one aggregation over the merged run.

    ``join_counts`` - the counts the strict merge observed - avoids a second
    pass over the inputs; without them V4 is one aggregation shuffle.
    """
    spark = merged.sparkSession
    if join_counts is not None:
        counts = spark.range(1).selectExpr(
            *[f"CAST({int(join_counts[c])} AS BIGINT) AS {c}" for c in MergeMetrics.FIELDS])
        expected = F.lit(int(join_counts["expected_rows"]))
    else:
        counts = check_join(s1, s2)
        expected = counts.select("expected_rows").scalar()
    return [
        join_check_rows(counts, (n1, n2)),
        merged_checks_one_pass(merged, n1, n2, ensemble, eps, expected_rows=expected),
    ]


def report_schema():
    """Check rows as produced by ``report``: run_id, scope, then the check columns."""
    fields = {f.name: f for f in report_contract().fields}
    return T.StructType([fields[c] for c in ("run_id", "scope", "check", "metric", "value",
                                               "threshold", "passed")])


def report_contract():
    return T.StructType(
        [
            T.StructField("scope", T.StringType()),
            T.StructField("check", T.StringType()),
            T.StructField("metric", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("threshold", T.DoubleType()),
            T.StructField("passed", T.BooleanType()),
            T.StructField("run_id", T.StringType()),
        ]
    )
