"""Every query of the metrics engine against DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from daybook.plans.catalog import ORACLE_SQL, QUERIES

DATA = os.environ.get("DAYBOOK_TESTDATA", "/root/testdata/sf0.001")


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(v, 9) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, db, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(repr([_plain(r[c]) for c in columns]) for r in df.collect())
    result = db.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(repr([_plain(r[names.index(c)]) for c in columns]) for r in result.fetchall())
    assert got == want
