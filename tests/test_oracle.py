"""Every registered query against its SQL, row for row as bags."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module

TESTDATA = "/root/testdata"
SCALES = [s for s in ("sf0.001", "sf0.01") if os.path.isdir(f"{TESTDATA}/{s}")]
QUERIES = entry_module.clean_up_queries()
ORACLE = entry_module.clean_up_sql()


@pytest.fixture(scope="module")
def databases():
    opened = {}
    for scale in SCALES:
        db = duckdb.connect()
        for name in ("customer", "orders", "lineitem", "events"):
            path = f"{TESTDATA}/{scale}/{name}.parquet"
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
        opened[scale] = db
    yield opened
    for db in opened.values():
        db.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


CASES = [(scale, name) for scale in SCALES for name in sorted(QUERIES)]


@pytest.mark.parametrize("scale,name", CASES)
def test_query_matches_sql(spark, databases, scale, name):
    found = QUERIES[name](spark, f"{TESTDATA}/{scale}")
    expected = databases[scale].execute(ORACLE[name])
    columns = [c[0] for c in expected.description]
    assert sorted(found.columns) == sorted(columns)
    expected_rows = expected.fetchall()
    found_rows = [tuple(row) for row in found.select(columns).collect()]
    assert len(found_rows) == len(expected_rows) > 0
    assert Counter(found_rows) == Counter(expected_rows)


def test_ordered_lookup_matches_sql_in_order(spark, databases):
    scale = SCALES[-1]
    rows = QUERIES["lookup_sessions_files"](spark, f"{TESTDATA}/{scale}").collect()
    expected = databases[scale].execute(ORACLE["lookup_sessions_files"]).fetchall()
    assert [tuple(row) for row in rows] == expected


def test_entry_returns_rows(spark):
    assert entry_module.entry(spark).count() > 0
