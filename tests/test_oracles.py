"""Every catalogued query against its SQL on the same tables."""

import pytest

from tesserae.plans import load_catalog

CATALOG = load_catalog()


@pytest.mark.parametrize("name", sorted(CATALOG.ORACLES))
def test_query_matches_sql(name, same_as_sql):
    same_as_sql(CATALOG.QUERIES[name], CATALOG.ORACLES[name])


def test_each_oracle_has_a_query():
    assert set(CATALOG.ORACLES) <= set(CATALOG.QUERIES)
    assert len(CATALOG.QUERIES) > 100


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
