"""Every query of the core runs over the smallest tables, and gives the rows of its SQL."""

import datetime
import glob
import math
import os
from decimal import Decimal

import duckdb
import pytest

from filigree.plans import registry

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def _plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "null"
    if isinstance(x, (float, Decimal)):
        return f"{float(x):.6f}"
    if isinstance(x, datetime.datetime):
        return x.isoformat()
    if isinstance(x, (list, tuple)):
        return "[" + ",".join(map(_plain, x)) + "]"
    return str(x)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted(tuple(_plain(r[c]) for c in columns) for r in df.collect())
    sql = registry.oracle_sql().get(name)
    if sql is None:
        return
    got = duck.execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(names) == columns
    assert rows == sorted(tuple(_plain(r[names.index(c)]) for c in columns) for r in got.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
