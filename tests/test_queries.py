"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry
from tidemark import plans
from tools.check import TABLES, digest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    got = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = duck.execute(sql)
    columns = [c[0] for c in result.description]
    wanted = result.fetchall()
    assert sorted(columns) == sorted(df.columns)
    assert len(got) == len(wanted)
    assert digest(got, df.columns) == digest(wanted, columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
