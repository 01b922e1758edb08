"""Every registered query with an oracle returns the oracle's rows."""

import os
from decimal import Decimal

import pytest

from plenum.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return float(v)
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted(repr(tuple(plain(r[c]) for c in columns)) for r in got.collect()) == sorted(repr(tuple(plain(r[k]) for k in at)) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
