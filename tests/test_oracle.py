"""Every registered query against DuckDB on the same files."""

import pytest
from compare import connect, mismatch
from conftest import SF_DIR

from ledgerlens.plans import ORACLE_SQL, QUERIES

ROWS_ONLY = {"model_scored", "model_metrics", "model_preview", "feature_importance", "model_metadata", "stream_model_scored", "model_attribution"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_is_checked():
    assert set(QUERIES) - set(ORACLE_SQL) == ROWS_ONLY
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, con, name):
    assert mismatch(QUERIES[name](spark, SF_DIR), con, ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns == ["merchant_category", "frauds", "total", "rate"]
    assert contract.entry(spark).count() == 10
    assert set(contract.oracle_sql()) <= set(contract.queries())
