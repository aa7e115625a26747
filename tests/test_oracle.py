"""Every query with SQL gives the SQL's rows; every other query gives rows."""

import pytest

import __spark_entry__ as entry
import compare

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(tables):
    return compare.connect(tables)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, tables, name):
    columns, got = compare.frame_rows(QUERIES[name](spark, tables))
    wanted_columns, wanted = compare.sql_rows(con, SQL[name])
    assert columns == wanted_columns
    assert len(got) == len(wanted)
    for a, b in zip(got, wanted):
        assert a == b
        assert [type(v) for v in a] == [type(v) for v in b]


@pytest.mark.parametrize("name", ["gibbs_mixture", "naive_bayes_ml"])
def test_rows_only(spark, tables, name):
    assert QUERIES[name](spark, tables).count() > 0
