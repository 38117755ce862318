"""Every query with an oracle gives the rows of its SQL on the smallest tables."""

import datetime
import glob
import math
import os
import subprocess
import sys

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.date()
    return value


def table(names, rows):
    order = sorted(names)
    at = [names.index(n) for n in order]
    tuples = [tuple(plain(row[i]) for i in at) for row in rows]
    return sorted(tuples, key=lambda r: [(v is None, v if v is not None else 0) for v in r])


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(name, spark, duck):
    df = queries()[name](spark, SF_DIR)
    cursor = duck.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert table(df.columns, df.collect()) == table(names, cursor.fetchall())


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    df = entry(spark)
    assert df.columns == ["race", "gender", "episodes", "returns", "return_rate", "share"]
    assert sum(r["share"] for r in df.collect()) == pytest.approx(1.0)


def test_entry_module_needs_no_session():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert e.queries()"], cwd=root, check=True)
