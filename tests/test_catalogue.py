"""Every query against its SQL on the smallest tables."""

import duckdb
import pytest

from kindred.plans.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(repr([("%.6g" % v if isinstance(v, float) else str(v)) if v == v and v is not None else None for v in r]) for r in df.itertuples(index=False))


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    a, b = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE_SQL[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a) == rows(b)
