"""Every registered query against its SQL twin in DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"
# The smallest tables hold no row for these filters.
EMPTY = {"search_page", "search_tags"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, con, name):
    problem = compare(spark, con, SF_DIR, queries()[name], oracle_sql()[name])
    assert problem is None or (name in EMPTY and problem == "both empty")


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_has_rows(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"event_type", "mape", "mae"}
