"""Every registered query against its SQL on the small tables."""

import pytest
from harness import compare, oracle

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
        return
    _, diff = compare(df, con, sql)
    assert diff == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 3
