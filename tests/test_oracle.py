"""Every registered query against its SQL, with types."""

import pytest
from compare import oracle, problems

import __spark_entry__ as entry
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) & set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = entry.queries()[name](spark, SF)
    assert problems(result, con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
