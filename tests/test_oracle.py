"""Every registered query against its SQL in DuckDB."""

import pytest
from compare import difference, duck

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_sql():
    own = entry.own_queries().keys()
    assert own <= entry.queries().keys() and own <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", list(entry.own_queries()))
def test_query(spark, connection, name):
    frame = entry.own_queries()[name](spark, SF_DIR)
    assert difference(frame, connection, entry.oracle_sql()[name]) is None
