"""The queries that brute-force SQL can answer, on the smallest tables."""

from pathlib import Path

import pandas as pd
import pytest

from corpuskit.llm.queries import ORACLE, QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.sql(f"create view {p.stem} as from '{p}'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    return sorted(tuple("null" if pd.isna(x) else f"{x:.6g}" if isinstance(x, float) else str(x) for x in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    got, want = QUERIES[name](spark, str(DATA)).toPandas(), duck.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
