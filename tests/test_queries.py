"""Every core query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from millrace.plans import registry

from .conftest import DATA


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return con


def plain(rows):
    def cell(v):
        if v is None:
            return "null"
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)):
            return f"{float(v):.6g}"
        return str(v)

    return sorted(tuple(cell(v) for v in r) for r in rows)


def test_every_oracle_has_a_query():
    assert set(registry.ORACLES) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, oracle, name):
    out = registry.QUERIES[name](spark, DATA)
    columns = sorted(out.columns)
    got = plain(out.select(*columns).collect())
    quoted = ", ".join(f'"{c}"' for c in columns)
    assert got == plain(oracle.execute(f"SELECT {quoted} FROM ({registry.ORACLES[name]})").fetchall())
