"""Every registered query agrees with its SQL on the smallest tables."""

import compare
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from creamline.catalog import QUERIES

SF = "sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    frame = queries()[name](spark, str(compare.TESTDATA / SF))
    assert compare.differences(frame, con, oracle_sql()[name]) == []


def test_every_query_has_sql():
    assert QUERIES.keys() <= oracle_sql().keys()
    assert oracle_sql().keys() <= queries().keys()


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
