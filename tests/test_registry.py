"""Every named query against its SQL on the smallest tables."""

import pytest
from oracle import difference, duck

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_its_sql(spark, con, name):
    assert difference(spark, con, name, FOLDER) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:3] == ["hour", "area", "code"] and df.count() > 0


def test_every_check_has_a_query():
    assert set(oracle_sql()) <= set(queries())
