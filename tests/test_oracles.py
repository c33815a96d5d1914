import os

import pytest

import __spark_entry__ as entry
from edgeweave import oracles, registry
from compare import connect, spark_bag, sql_bag

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_same_keys():
    assert set(registry.queries()) == set(oracles.oracle_sql())


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_matches_sql(spark, con, name):
    got_columns, got = spark_bag(registry.queries()[name](spark, SF_DIR))
    want_columns, want = sql_bag(con, oracles.oracle_sql()[name])
    assert got_columns == want_columns
    assert sum(got.values()) == sum(want.values()) > 0
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).collect()[0].asDict() == {"rows": 12916, "triangles": 4305}
