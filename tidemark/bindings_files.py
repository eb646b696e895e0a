"""Tables written as files by way of the committed sink, and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.bindings import query, table
from tidemark.session import shared_base
from tidemark.sources import committed


@query("""SELECT CAST(row_number() OVER (ORDER BY o_orderdate, o_custkey, o_orderkey) AS BIGINT) AS line, strftime(o_orderdate, '%Y-%m-%d') || ',' || o_custkey || ',' || o_orderkey || ',' || printf('%.1f', o_totalprice) AS value
FROM orders""")
def committed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as sorted text parts, committed twice to the same place, and their lines as read back."""
    orders = table(spark, sf_dir, "orders")
    day = orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    path = committed.as_uri(f"{shared_base(spark).rstrip('/')}/committed-{uuid.uuid4().hex}")
    formats = {"o_orderdate": ("text", 0), "o_custkey": ("text", 0), "o_orderkey": ("text", 0), "o_totalprice": ("fixed", 1)}
    committed.write_committed(day.filter(F.col("o_orderkey").isNull()), path, ["o_orderdate", "o_custkey"], formats, ["# orders"])
    committed.write_committed(day, path, ["o_orderdate", "o_custkey"], formats, ["# orders"])
    return committed.read_committed(spark, path).select("line", "value")
