"""Scratch folders go by one call, and only they."""

import os
import subprocess
import sys

from tests.conftest import ROOT

RUN = """
import os, sys
from scorewell.session import checkpoint_root, get_session, remove_scratch, scratch_location
spark = get_session("local[2]", shuffle_partitions=2)
spark.sparkContext.setCheckpointDir(sys.argv[1])
folder = scratch_location(spark, "some result")
spark.range(5).write.parquet(folder)
kept = checkpoint_root(spark) + "/kept"
spark.range(3).write.parquet(kept)
assert os.path.exists(folder.removeprefix("file:"))
assert remove_scratch(spark) and not remove_scratch(spark)
assert not os.path.exists(folder.removeprefix("file:")) and spark.read.parquet(kept).count() == 3
spark.range(5).write.parquet(scratch_location(spark, "again"))
print("REMOVED")
"""


def test_scratch_folders_are_removed_by_one_call(tmp_path):
    """In a process of its own: this session's tests still read theirs."""
    out = subprocess.run([sys.executable, "-c", RUN, str(tmp_path / "ckpt")], cwd=tmp_path, env=dict(os.environ, PYTHONPATH=ROOT),
                         capture_output=True, text=True, timeout=300)
    assert "REMOVED" in out.stdout, out.stderr[-2000:]
