"""Every registered query against its SQL, and the shape of the physical plans."""

import pytest
from oracle import compare, duck

from sparkdesk.plans import load_all
from sparkdesk.plans.registry import ORACLES, QUERIES

load_all()
SLOW = ("k03", "k05", "k06_best", "k11", "k12", "x21", "x23")  # iterative: run by their own tests


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    ok, note = compare(df, con, ORACLES[name])
    assert ok, note
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in ORACLES and not n.startswith(SLOW)))
def test_runs_without_sql(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_scan_prunes_and_filters(spark, sf_dir):
    from sparkdesk.operators.demand import where_equal
    from sparkdesk.plans.tables import Tables

    df = where_equal(Tables(spark, sf_dir).daily, line="R")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in plan
    assert "l_extendedprice" not in plan


def test_every_inventory_id_is_registered():
    ids = {n.split("_")[0] for n in QUERIES}
    want = {f"{p}{i:02d}" for p, n in (("s", 18), ("p", 31), ("j", 23), ("m", 8), ("a", 33), ("w", 18), ("b", 23), ("x", 23), ("v", 11), ("k", 22), ("r", 3))
            for i in range(1, n + 1)}
    assert want - ids == set()
