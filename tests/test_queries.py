"""Every registered query against its SQL, on the smallest test data."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"

# Queries of the training-data operators have tests of their own.
CORE = [name for name, build in entry.queries().items() if not build.__module__.startswith("loomcart.llm")]


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", CORE)
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(step in plan for step in ("CartesianProduct", "NestedLoopJoin", "PythonUDF"))
    assert differences(df, db.sql(entry.oracle_sql()[name])) == []


def test_every_query_has_sql():
    assert set(CORE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
