"""Every query of the library runs on the smallest tables, and equals its SQL in DuckDB where it has one."""

import math
import os

import duckdb
import pytest

from tidemark.plans import catalogue

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(D):
        c.sql(f"create view {f[:-8]} as select * from '{D}/{f}'")
    return c


def rows(names, table):
    def plain(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return "-"
        return f"{v:.5f}" if isinstance(v, float) else str(v)

    return sorted(tuple(plain(r[n]) for n in sorted(names)) for r in table)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, D)
    got = [r.asDict() for r in df.collect()]
    if name in catalogue.ORACLE_SQL:
        found = duck.sql(catalogue.ORACLE_SQL[name])
        assert sorted(found.columns) == sorted(df.columns)
        want = [dict(zip(found.columns, r, strict=True)) for r in found.fetchall()]
        assert rows(df.columns, got) == rows(df.columns, want)
    else:
        assert got is not None and len(df.columns) > 1
