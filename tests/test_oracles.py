"""Every registered query gives the rows of its DuckDB SQL."""

import oracle
import pytest

import __spark_entry__ as registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


def test_every_oracle_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert oracle.spark_rows(df) == oracle.duck_rows(duck, SQL[name])


def test_entry_runs(spark):
    assert registry.entry(spark).count() > 0
