"""Every registered query against its SQL counterpart, on the smallest tables."""

import datetime
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from workload.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return round(value, 9) if isinstance(value, float) else value


def comparable(names, rows):
    order = [names.index(n) for n in sorted(names)]
    return sorted(repr([plain(row[i]) for i in order]) for row in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_every_query_of_the_workload_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    rows = entry.queries()[name](spark, SF_DIR)
    want = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(rows.columns) == sorted(names)
    assert comparable(rows.columns, rows.collect()) == comparable(names, want.fetchall())
    assert rows.columns


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 1


def test_entry_is_imported_without_a_session():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"], cwd=root)
    assert done.returncode == 0
