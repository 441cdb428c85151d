import glob
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry




def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    return float(v) if isinstance(v, (int, float, Decimal)) else str(v)


def test_entry_runs(spark, data):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_sql_agrees(spark, data, name):
    con = duckdb.connect()
    for f in glob.glob(f"{data}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    cur = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    want = sorted((tuple(plain(v) for _, v in sorted(zip(columns, r, strict=True))) for r in cur.fetchall()), key=str)
    df = entry.queries()[name](spark, data)
    assert sorted(df.columns) == sorted(columns)
    got = sorted((tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=str)
    assert got == want
