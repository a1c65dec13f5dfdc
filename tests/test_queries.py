"""Every registered query against its SQL, over whole supplied tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from oracle import oracle_sql as expected
from starmart.plans.queries import QUERIES as MART_QUERIES

FOLDER = os.environ.get("STARMART_SF_DIR", "/root/testdata/sf0.001")
SUPPLIED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
# the optional queries have tests of their own
QUERIES, EXPECTED = MART_QUERIES, expected()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in SUPPLIED:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("" if r[i] is None else str(r[i]) for i in order) for r in rows)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == EXPECTED.keys()
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert EXPECTED.keys() <= entry_point.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(EXPECTED[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    expected = canonical(columns, cursor.fetchall())
    assert expected
    assert canonical(result.columns, [tuple(r) for r in result.collect()]) == expected


def test_entry(spark):
    assert entry_point.entry(spark).limit(1).count() == 1
