"""Every registered query against its SQL, and the shape of its plan."""

import pytest

from brackish.plans.registry import ORACLES, QUERIES, load_all
from tests.oracle import compare, connect

load_all()
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = df.toArrow()
    assert compare(got, con.execute(ORACLES[name]).to_arrow_table()) == []


def test_entry_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 100
