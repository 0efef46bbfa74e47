"""Every registered query against its SQL, over whole tables."""

import pytest

from bidscope.plans.registered import queries
from checks.compare import connect, difference
from checks.oracles import oracle_sql
from tests.conftest import CHECK_DIR as SF_DIR


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, connection, name):
    result = queries()[name](spark, SF_DIR)
    got = (result.columns, [tuple(row) for row in result.collect()])
    answer = connection.execute(oracle_sql()[name])
    assert got[1], "a query without rows checks nothing"
    assert difference(got, ([c[0] for c in answer.description], answer.fetchall())) is None


def test_no_query_pairs_everything_with_everything(spark):
    for name in ("kpi_scorecard", "q_wow", "q_depth_buckets", "floor_sensitivity", "did_ecpm", "star_by_tier"):
        plan = queries()[name](spark, SF_DIR)._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_scan_reads_only_what_is_used(spark):
    plan = queries()["kpi_scorecard"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "p_name" not in plan
