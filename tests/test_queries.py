"""Every registered query against its SQL, on the smallest data."""

from __future__ import annotations

import pytest
from oracle import connect, differences

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
# boosting with its 200 rounds is covered by a shorter run elsewhere
SLOW = {"hotspot_gbt"}
NAMES = sorted(set(entry.queries()) - SLOW)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert differences(df, con, sql) == []


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [r["state"] for r in rows] == sorted(r["state"] for r in rows) and len(rows) == 5


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
