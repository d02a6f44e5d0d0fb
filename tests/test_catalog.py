"""Every named query against its SQL in another engine."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = oracle_sql()

@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    frame = queries()[name](spark, FOLDER)
    if name in SQL:
        assert difference(db, frame, SQL[name]) is None
    else:
        assert frame.count() > 0


def test_entry(spark):
    assert entry(spark).columns == ["datetime", "cell_id", "count"]


def test_names():
    assert set(SQL) <= set(queries())
