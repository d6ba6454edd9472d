"""Every query of the library's own operators against its SQL, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from pageloom.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{name}')")
    return con


def plain(df):
    df = df[sorted(df.columns)].astype(object)
    value = lambda x: None if pd.isna(x) else round(float(x), 6) if isinstance(x, (int, float)) or hasattr(x, "dtype") else x
    return sorted((repr([value(x) for x in row]) for row in df.values.tolist()))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, tables, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    assert len(got) or name in ("key_filter", "error_report", "band_pairs")
    if name in registry.SQL:
        want = tables.execute(registry.SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(got) == plain(want)


def test_entry():
    import __spark_entry__ as E

    assert set(registry.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
