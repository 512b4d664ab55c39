"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from check_results import TABLES, rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables here")


@pytest.fixture(scope="module")
def db():
    found = duckdb.connect()
    for name in TABLES:
        found.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return found


# queries of the corpus operators have tests of their own
NAMES = sorted(name for name in entry.queries() if not re.match(r"op\d+_|pipeline$", name))


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SF_DIR)
    answer = db.execute(entry.oracle_sql()[name])
    columns = [column[0] for column in answer.description]
    assert sorted(df.columns) == sorted(columns)
    got, expected = rows(df.columns, df.collect()), rows(columns, answer.fetchall())
    assert got == expected
    assert sum(got.values()) > 0


def test_every_query_has_its_sql():
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
