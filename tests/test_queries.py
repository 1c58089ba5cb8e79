"""Every query of the engine against its SQL on DuckDB: the same columns, types and rows."""

import decimal
import os

import duckdb
import pytest

from lorekeeper.catalog import ORACLE_SQL, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    return con


def plain(v):
    return round(v, 9) if isinstance(v, float) else float(v) if isinstance(v, decimal.Decimal) else v


def test_names():
    assert len(QUERIES) > 130 and set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*columns).collect()), key=repr)
    if name not in ORACLE_SQL:
        assert got
        return
    cursor = database.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in order) for r in cursor.fetchall()), key=repr)
