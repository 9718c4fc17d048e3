"""Every registered query equals its DuckDB oracle (exact values, any order)."""

import pytest

import __spark_entry__ as entry
from scorewell.plans.oracles import ORACLES
from scorewell.plans.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_util import compare, duck


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    (cols, rows), (ocols, orows) = compare(df, con, ORACLES[name])
    assert cols == ocols
    assert len(rows) == len(orows)
    assert rows == orows


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "model_1_score", "model_2_score", "ensemble_score", "run_id"]
    assert df.count() > 0
