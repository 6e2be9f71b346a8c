"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_sql_belongs_to_a_query():
    assert oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name) == ""


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["user", "item", "rating", "prediction", "abs_err"] and df.count() > 0
