"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from stratalake import workload
from tests.oracle import compare, connect

workload.load_all()
QUERIES, ORACLES = workload.QUERIES, workload.ORACLES


@pytest.fixture(scope="module")
def database(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert len(QUERIES) > 90


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, database, name):
    _, problem = compare(QUERIES[name](spark, sf_dir), database, ORACLES[name])
    assert problem is None


def test_flagship(spark):
    assert not entry.entry(spark).isEmpty()
