import os

import duckdb
import pytest

import __spark_entry__ as entry
from skyledger.plans.oracles import ORACLES
from skyledger.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    names = sorted(got.columns)
    want = duck.sql(ORACLES[name])
    assert names == sorted(want.columns)
    quoted = ", ".join(f'"{n}"' for n in names)
    assert sorted(map(repr, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(repr, duck.sql(f"SELECT {quoted} FROM ({ORACLES[name]})").fetchall()))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
