"""Every registered query against its SQL twin."""

from __future__ import annotations

import oracle
import pytest

from feedmill.plans import catalog

#: Fitted by iteration; test_trained holds its accuracy on held-out rows.
ROWS_ONLY = {"sentiment_trained"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, con, sf_dir, name):
    problem = oracle.compare(spark, con, name, catalog.QUERIES[name], catalog.ORACLES[name], sf_dir)
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, sf_dir, name):
    assert name in ROWS_ONLY
    assert catalog.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
