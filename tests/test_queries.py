"""Every registered query against its SQL, exactly."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check  # noqa: E402

from ledgerline.suite import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert check.compare(spark, duck, SF_DIR, name) is None


def test_every_query_has_sql():
    assert [name for name, q in QUERIES.items() if q.sql is None] == []


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 10
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())
