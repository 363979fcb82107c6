"""Registered queries against their SQL, on the smallest tables."""

import glob
import math
import os

import pytest

from loomvec.plans import queries as Q

DATA = "/root/testdata/sf0.001"


def shown(value):
    return None if value is None or isinstance(value, float) and math.isnan(value) else value


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    frame = Q.queries()[name](spark, DATA)
    want = con.sql(Q.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(want.columns)
    left = sorted(repr([shown(r[c]) for c in sorted(frame.columns)]) for r in frame.collect())
    right = sorted(repr([shown(x) for _, x in sorted(zip(want.columns, r, strict=True))]) for r in want.fetchall())
    assert left == right
