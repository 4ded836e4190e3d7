"""Every query runs, and gives the rows of its SQL."""

import glob
import os

import duckdb
import pytest

from framewright import catalog


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def same(v):
    if isinstance(v, float):
        return repr(round(v, 6))
    return str([same(x) for x in v]) if isinstance(v, (list, tuple)) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, sf, duck, name):
    df = catalog.queries()[name](spark, sf)
    cols = sorted(df.columns)
    rows = sorted([same(r[c]) for c in cols] for r in df.collect())
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert name in {"greedy_nms", "stub_embed", "reconcile_lines", "ocr_crosscheck", "advert_plan", "slide_split"}
        return
    got = duck.sql(sql)
    assert sorted(got.columns) == cols
    at = [got.columns.index(c) for c in cols]
    assert rows == sorted([same(r[k]) for k in at] for r in got.fetchall())
