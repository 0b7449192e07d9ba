"""Every registered query against its SQL equivalent, at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from verification.compare import difference

EQUIVALENTS = oracle_sql()


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, sf_dir, name):
    count, problem = difference(spark, sf_dir, queries()[name], EQUIVALENTS.get(name))
    assert not problem, problem


def test_every_equivalent_has_a_query():
    assert set(EQUIVALENTS) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
