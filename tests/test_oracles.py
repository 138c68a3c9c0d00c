"""Every registered query against its SQL equivalent, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from tests.support.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_point.QUERIES, entry_point.ORACLES

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_an_equivalent():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), connection, ORACLES[name]) is None


def test_entry(spark):
    assert entry_point.entry(spark).count() == 10
