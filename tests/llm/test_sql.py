"""Queries of the subpackage against their SQL."""

import duckdb
import pytest

from framewright.llm import queries
from framewright.llm.sql import SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, sf, name):
    duck = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        duck.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = duck.sql(SQL[name])
    at = [got.columns.index(c) for c in cols]
    assert sorted(got.columns) == cols
    assert sorted(str([r[c] for c in cols]) for r in df.collect()) == sorted(str([r[k] for k in at]) for r in got.fetchall())
