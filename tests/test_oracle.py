"""Every registered query with an oracle equals DuckDB on the smallest tables; the others return rows."""

import os

import duckdb
import pandas as pd
import pytest

from spanforge import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(df):
    df = df[sorted(df.columns)]
    rows = [tuple(None if pd.isna(x) else round(float(x), 4) + 0.0 if isinstance(x, float) else int(x) if hasattr(x, "__int__") and not isinstance(x, str) else x for x in r) for r in df.itertuples(index=False)]
    return list(df.columns), sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = plain(registry.queries()[name](spark, SF).toPandas())
    if name in registry.oracle_sql():
        assert got == plain(duck.execute(registry.oracle_sql()[name]).df())
    else:
        assert got[0]
