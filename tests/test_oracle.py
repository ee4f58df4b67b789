"""Every registered query against its SQL twin."""

import pytest
from oracle import compare, connect

from tidemark.contract import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_each_query_has_a_twin():
    assert set(SQL) <= set(QUERIES)
    assert not set(QUERIES) - set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, SQL[name]) > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
