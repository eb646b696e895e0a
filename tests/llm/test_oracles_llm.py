"""The corpus queries with SQL against DuckDB: on the smallest tables, and helpers for tables of a test's own."""

from __future__ import annotations

import os

import duckdb
import pytest

from tests.test_oracles import SF, compare, normal
from tidemark.llm import queries


def compare_tables(spark, f, sql, tables):
    """``f`` over the tables, in their order, equals the SQL over the same rows. ``tables``: name to (rows, schema)."""
    frames = {name: spark.createDataFrame(rows, schema) for name, (rows, schema) in tables.items()}
    con = duckdb.connect()
    for name, df in frames.items():
        arrow = df.toArrow()  # noqa: F841, read by name
        con.execute(f"create table {name} as select * from arrow")
    got = f(*frames.values())
    columns = sorted(got.columns)
    expected = con.execute(f"select {', '.join(columns)} from ({sql})").fetchall()
    assert normal(tuple(r) for r in got.select(*columns).collect()) == normal(expected)


@pytest.mark.skipif(not os.path.isdir(SF), reason="the standard tables are not here")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    compare(spark, queries.QUERIES[name], queries.ORACLE_SQL[name])
