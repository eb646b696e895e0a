"""Every query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import glob
import math
import os
from decimal import Decimal

import duckdb
import pytest

from tidemark import bindings

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the standard tables are not here")


def normal(rows):
    def value(v):
        if isinstance(v, (float, Decimal)):
            return "nan" if math.isnan(v) else float(f"{float(v):.9g}") + 0.0
        return v

    return sorted((tuple(value(v) for v in r) for r in rows), key=repr)


def compare(spark, query, sql, sf_dir=SF):
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    expected = normal(con.execute(f"select {', '.join(columns)} from ({sql})").fetchall())
    assert normal(tuple(r) for r in df.select(*columns).collect()) == expected


@pytest.mark.parametrize("name", sorted(bindings.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    compare(spark, bindings.QUERIES[name], bindings.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(bindings.QUERIES) - set(bindings.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    assert bindings.QUERIES[name](spark, SF).count() >= 0


def test_entry_points():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert callable(e.entry)
