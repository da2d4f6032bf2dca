"""Queries that SQL can express, against that SQL."""

import os

import duckdb
import pytest

from skyledger.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    names = sorted(got.columns)
    quoted = ", ".join(f'"{n}"' for n in names)
    want = con.sql(f"SELECT {quoted} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(repr, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(repr, want))
