"""Looking a run up changes nothing, and sees what other processes have stored."""

import os
import subprocess
import sys

import pytest

from scorewell.functions.models import LinearModel
from scorewell.plans.jobs import merge_job, score_job
from scorewell.session import scratch_location
from scorewell.sources.catalog import (
    ensure_database,
    read_run,
    refresh_run,
    run_counts,
    run_exists,
    run_folder,
    run_rows,
    run_status,
    table_location,
)
from tests.conftest import ROOT

M1 = LinearModel.of("model_1", {"x": 0.5})
NOW = "2026-01-01 12:00:00"

OTHER = """
import sys
from scorewell.functions.models import LinearModel
from scorewell.plans.jobs import score_job
from scorewell.session import get_session
spark = get_session("local[2]", shuffle_partitions=2)
place, db, *runs = sys.argv[1:]
for k, run in enumerate(runs, 1):
    f = spark.createDataFrame([(str(i), 1.0) for i in range(k)], "id string, x double")
    for name in ("model_1", "model_2"):
        model = LinearModel.of(name, {"x": 0.5})
        score_job(spark, model, f, db, f"{name}_scores", run, now="2026-01-01 12:00:00", location=place, force=True)
spark.stop()
"""


def feats(spark, n):
    return spark.createDataFrame([(str(i), 1.0) for i in range(n)], "id string, x double")


def partitions(spark, table):
    return sorted(r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())


def folders(spark, table):
    return sorted(f for f in os.listdir(table_location(spark, table).removeprefix("file:")) if f.startswith("run_id="))


@pytest.fixture()
def shared(spark, tmp_path):
    """(database, write): this session declares both score tables; ``write`` stores runs from another process."""
    place = scratch_location(spark, "lookups")
    db = "lookups_" + os.path.basename(place)[-8:]
    ensure_database(spark, db, location=place)
    for name in ("model_1", "model_2"):
        score_job(spark, LinearModel.of(name, {"x": 0.5}), feats(spark, 7), db, f"{name}_scores", "r0", now=NOW)

    def write(*runs):
        out = subprocess.run([sys.executable, "-c", OTHER, place, db, *runs], cwd=tmp_path, env=dict(os.environ, PYTHONPATH=ROOT), capture_output=True, text=True, timeout=300)
        assert out.returncode == 0, out.stderr[-2000:]

    return db, write


def test_lookups_of_an_absent_run_leave_no_trace(spark, db):
    t = f"{db}.model_1_scores"
    score_job(spark, M1, feats(spark, 3), db, "model_1_scores", "r1", now=NOW)
    before = partitions(spark, t), folders(spark, t)
    assert not run_exists(spark, t, "no_such_run") and not refresh_run(spark, t, "no_such_run")
    assert run_rows(spark, t, "no_such_run") == 0 and read_run(spark, t, "no_such_run").count() == 0
    assert {r["run_id"] for r in run_status(spark, {"m": t}).collect()} == {"r1"}
    with pytest.raises(ValueError, match="has no rows"):
        merge_job(spark, db, "no_such_run", now=NOW)
    assert (partitions(spark, t), folders(spark, t)) == before == (["run_id=r1"], ["run_id=r1"])


def test_lookups_of_a_table_without_runs(spark, db):
    from scorewell.contracts import score_contract
    from scorewell.sources.catalog import ensure_table

    t = f"{db}.model_1_scores"
    ensure_table(spark, t, score_contract("model_1"))
    assert not run_exists(spark, t, "r1") and run_rows(spark, t, "r1") == 0
    assert run_status(spark, {"m": t}).count() == 0 and run_rows(spark, f"{db}.none", "r1") == 0


def test_each_lookup_sees_the_runs_of_another_process(spark, shared):
    """Each function is the first of this session to hear of its run."""
    db, write = shared
    t = f"{db}.model_1_scores"
    write("a1", "a2", "a3", "a4", "a5")
    assert run_rows(spark, t, "a2") == 2  # A1
    assert run_exists(spark, t, "a3")  # R1
    assert score_job(spark, M1, feats(spark, 9), db, "model_1_scores", "a4", now=NOW).skipped  # R1 in the job
    assert merge_job(spark, db, "a5", now=NOW).rows == 5  # K6: the merge reads both sides
    assert "run_id=a1" not in partitions(spark, t)
    status = {r["run_id"]: (r["m1"], r["m2"]) for r in run_status(spark, {"m1": t, "m2": f"{db}.model_2_scores"}).collect()}  # R3
    assert status == {"r0": (7, 7)} | {f"a{k}": (k, k) for k in range(1, 6)}
    # Replaced by another process: the old listing isn't used again.
    write("a5")
    assert run_rows(spark, t, "a5") == 1
    write("x", "a3")
    assert {r["run_id"]: r["rows"] for r in run_counts(spark, {"m": t}).collect()}["a3"] == 2


def test_a_run_whose_folder_is_gone_is_absent(spark, db):
    t = f"{db}.model_1_scores"
    for run in ("r1", "r2"):
        score_job(spark, M1, feats(spark, 3), db, "model_1_scores", run, now=NOW)
    folder = run_folder(spark, t, "r1").removeprefix("file:")
    os.rename(folder, f"{folder}-gone")  # as another process would remove it
    assert not run_exists(spark, t, "r1") and run_rows(spark, t, "r1") == 0
    assert score_job(spark, M1, feats(spark, 4), db, "model_1_scores", "r1", now=NOW).rows == 4
    assert run_rows(spark, t, "r1") == 4 and run_rows(spark, t, "r2") == 3
