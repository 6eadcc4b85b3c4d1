"""Every registered query against its SQL, and the plans they run as."""

import pytest
from conftest import SF_DIR
from oracle_check import connect, difference

import __spark_entry__ as entry

from recordlake.oracles import ORACLES
from recordlake.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(base_spark, con, name):
    df = QUERIES[name](base_spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
    assert difference(df, con, ORACLES[name]) is None


def test_entry(base_spark):
    df = entry.entry(base_spark)
    assert len(df.columns) == 12
    assert df.count() == 8700


def test_narrow_queries_do_not_shuffle(base_spark, spark):
    import recordlake.fixtures as fixtures
    from recordlake.queries import staged
    from recordlake.operators.unify import unify
    from recordlake.plans.specs import PRIORITY

    plain = lambda s, d, name: s.read.parquet(f"{d}/{name}.parquet")
    spread, fixtures.table = fixtures.table, plain
    try:
        df = unify({t: staged(spark, SF_DIR, t) for t in PRIORITY})
    finally:
        fixtures.table = spread
    plan = df._jdf.queryExecution().executedPlan().toString()
    # what inputs lack is broadcast; nothing else moves
    assert plan.count("Exchange") == plan.count("BroadcastExchange")


def test_first_match_leaves_every_type_somewhere(base_spark):
    types = QUERIES["unify_first_match"](base_spark, SF_DIR).select("resource_type").distinct()
    assert types.count() == 4
