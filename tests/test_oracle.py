"""(c) of the survey's test plan: every registered query equals its DuckDB oracle
(row count, column names, order-insensitive values) on sf0.001."""
import os

import pytest

import __spark_entry__ as entry
from tools.check_oracle import duck_connect, rows_of

from .conftest import SF

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    srows = [r.asDict() for r in sdf.collect()]
    if name not in ORACLE:
        assert srows is not None
        return
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    drows = [dict(zip(cols, r)) for r in cur.fetchall()]
    assert sorted(sdf.columns) == sorted(cols)
    assert len(srows) == len(drows)
    assert rows_of(srows, sorted(cols)) == rows_of(drows, sorted(cols))


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["funder", "aging_bucket", "n_items", "open_amt"]
