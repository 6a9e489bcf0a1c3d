"""Every registered core query against its DuckDB SQL on the smallest tables."""

import os

import duckdb
import pytest

from ledgerstream.plans.oracles import oracle_sql
from ledgerstream.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


def rows(names, data, order):
    text = lambda x: f"{float(x):.6f}" if isinstance(x, float) or type(x).__name__ == "Decimal" else str(x)
    return sorted(tuple(text(r[names.index(c)]) for c in order) for r in data)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches(spark, con, name):
    df = REGISTRY[name](spark, SF)
    c = con.execute(SQL[name])
    names = [d[0] for d in c.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, df.collect(), sorted(names)) == rows(names, c.fetchall(), sorted(names))
