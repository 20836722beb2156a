import pytest

import __spark_entry__ as entry_points
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
KNOWN, SQL = entry_points.queries(), entry_points.oracle_sql()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(KNOWN)


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["isbn", "n_ratings", "title", "publisher"]


@pytest.mark.parametrize("name", KNOWN)
def test_query(spark, name):
    assert compare(spark, connect(SF_DIR), name, SF_DIR, KNOWN, SQL) is None
