"""Every engine query against its SQL in another engine, on the smallest tables."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

from tessera import layer_queries as Q

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


def plain(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    return sorted(tuple("null" if pd.isna(v) else f"{float(v):.6g}" if isinstance(v, float) else str(v) for v in row) for row in df.astype(object).values.tolist())


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query(spark, duck, name):
    got, want = Q.QUERIES[name](spark, DIR).toPandas(), duck.execute(Q.ORACLES[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)
