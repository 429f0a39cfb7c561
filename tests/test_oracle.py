"""Every registered query with SQL gives the same rows as DuckDB."""

import pytest

import __spark_entry__ as entry_module
from tests.conftest import SF
from tools.check_oracle import compare, duck

ORACLE = entry_module.oracle_sql()
QUERIES = entry_module.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert compare(got, con.execute(ORACLE[name]).df()) is None


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    frame = entry_module.entry(spark).toPandas()
    assert set(frame["split"]) <= {"train", "validation"} and frame["examples"].sum() > 0
