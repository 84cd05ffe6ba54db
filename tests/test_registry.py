"""Every registered query against its SQL on DuckDB."""

import pytest

import __spark_entry__ as entry_module
from check_oracle import compare, duck
from registry import oracles
from registry import queries as registered

QUERIES, SQL = registered.QUERIES, oracles.SQL


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert set(QUERIES) <= set(entry_module.queries())


def test_sql_is_independent_of_the_package():
    with open(oracles.__file__, encoding="utf8") as f:
        assert "import sentloom" not in (source := f.read()) and "from sentloom" not in source


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    ok, note = compare(spark, con, sf, name, QUERIES[name], SQL.get(name))
    assert ok, note


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["corpus", "threshold", "n_pairs"]
    assert df.count() > 0
