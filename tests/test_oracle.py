"""Every registered query against its SQL, on whole tables."""

import pytest

import workloads
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(workloads.QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, name) is None


def test_every_query_has_its_sql():
    assert set(workloads.ORACLES) == set(workloads.QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
