"""Every registered query against its SQL counterpart on the smallest given tables."""

from pathlib import Path

import pytest

from checks.catalog import QUERIES, SQL
from checks.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="given tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, FOLDER, name)
    assert ok, note


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(SQL)
    assert entry.entry(spark).count() == 9
