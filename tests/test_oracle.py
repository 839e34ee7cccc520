"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_util import digest, duck

ORACLE = E.oracle_sql()
RESULTS_ONLY = sorted(set(E.queries()) - set(ORACLE))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    got = digest(E.queries()[name](spark, SF_SMALL).toPandas())
    want = digest(con.execute(ORACLE[name]).df())
    assert got[:3] == want[:3], (set(got[3]) - set(want[3]), set(want[3]) - set(got[3]))


@pytest.mark.parametrize("name", RESULTS_ONLY)
def test_results_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() > 0


def test_entry_and_registry(spark):
    assert set(ORACLE) <= set(E.queries())
    df = E.entry(spark)
    assert df.columns == ["total_hash", "mean_fee_rate", "volume_sat"]
    assert df.count() == 1
