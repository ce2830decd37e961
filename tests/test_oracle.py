"""Every registered map query against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from gridloom.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    left = sorted(str(tuple(plain(r[c]) for c in columns)) for r in got.collect())
    right = sorted(str(tuple(plain(r[i]) for i in at)) for r in want.fetchall())
    assert left == right
