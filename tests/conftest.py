import os
import sys
import uuid

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from scorewell.session import checkpoint_root, get_session

    s = get_session("local[*]", shuffle_partitions=8)
    checkpoint_root(s)  # uses spark.checkpoint.dir; sets a temp one only if unset
    yield s
    s.stop()


@pytest.fixture()
def db(spark):
    """A fresh database under the shared scratch folder."""
    from scorewell.session import scratch_location
    from scorewell.sources.catalog import ensure_database

    name = f"t_{uuid.uuid4().hex[:10]}"
    ensure_database(spark, name, location=scratch_location(spark, name))
    return name
