"""Every query with SQL gives the rows that DuckDB gives."""

import math

import duckdb
import pytest

from lectern.plans import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    rows = [tuple(plain(r[c]) for c in sorted(got.columns)) for r in got.collect()]
    if name not in SQL:
        assert rows
        return
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(got.columns)
    expected = [tuple(plain(v) for _, v in sorted(zip(names, r, strict=True))) for r in cursor.fetchall()]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
