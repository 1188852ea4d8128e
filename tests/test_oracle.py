"""Every query with an SQL counterpart agrees with it on a second engine."""

import compare
import pytest
from scales import SMALL

import __spark_entry__ as entry_points

SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = compare.connect(SMALL)
    yield con
    con.close()


def test_every_sql_text_has_a_query():
    assert set(SQL) <= set(entry_points.queries())


@pytest.mark.parametrize("key", SQL)
def test_query_agrees(spark, duck, key):
    df = entry_points.queries()[key](spark, SMALL)
    assert compare.difference(df, duck, SQL[key]) is None


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() == 5
