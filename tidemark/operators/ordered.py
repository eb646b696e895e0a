"""Order within a long series without putting a whole series into one task.

A series is cut into buckets that follow its order. Work within a bucket is an ordinary window; what a bucket needs from
those before it (a count, a last row, half a moving window) is carried over by a small second pass with one row per
bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Samples of a bucket, on average over the time that a series spans.
SAMPLES = 4096


def bucketed(df: DataFrame, key: list[str], order: str = "t", samples: int | None = None, name: str = "_bucket") -> tuple[DataFrame, DataFrame]:
    """``df`` with the number of its bucket, and the buckets' bounds per key (key, _from, _width) to place other rows alike.

    Buckets divide the time between a key's first and last row evenly, so that they hold ``samples`` rows on average.
    """
    span = df.groupBy(*key).agg(F.min(order).alias("_from"), F.max(order).alias("_to"), F.count(F.lit(1)).alias("_n"))
    width = (F.col("_to") - F.col("_from")) / F.greatest(F.lit(1.0), F.col("_n") / float(samples or SAMPLES))
    bounds = span.select(*key, "_from", F.when(width > 0, width).otherwise(1.0).alias("_width"))
    return placed(df, bounds, key, order, name), bounds


def placed(df: DataFrame, bounds: DataFrame, key: list[str], order: str = "t", name: str = "_bucket") -> DataFrame:
    """``df`` with the number of the bucket of its own ``order``; rows before the first bucket have numbers below zero."""
    rows = df.join(bounds, key) if key else df.crossJoin(F.broadcast(bounds))  # one row
    return rows.withColumn(name, F.floor((F.col(order) - F.col("_from")) / F.col("_width"))).drop("_from", "_width")


def beside(df: DataFrame, key: list[str], order: str, columns: dict[str, str], ahead: bool = False, bucket: str = "_bucket") -> DataFrame:
    """``df`` with values of the row before (or, ``ahead``, behind) it. ``columns``: new name to column; ``df`` has its buckets."""
    row = F.struct(*[F.col(c).alias(n) for n, c in columns.items()])
    step, edge = (F.lead, F.min_by) if ahead else (F.lag, F.max_by)
    edges = df.groupBy(*key, bucket).agg(edge(row, order).alias("_edge"))
    edges = edges.withColumn("_carried", step("_edge").over(Window.partitionBy(*key).orderBy(bucket))).drop("_edge")
    inside = df.withColumn("_inside", step(row).over(Window.partitionBy(*key, bucket).orderBy(order)))
    out = inside.join(edges, [*key, bucket])
    return out.withColumns({n: F.coalesce("_inside", "_carried")[n] for n in columns}).drop("_inside", "_carried")


def running_sum(df: DataFrame, key: list[str], order: list[Column | str], value: str, name: str, bucket: str = "_bucket") -> DataFrame:
    """``df`` with the sum of ``value`` up to and with each row."""
    sums = df.groupBy(*key, bucket).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = F.sum(value).over(Window.partitionBy(*key, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(name, inside).join(sums, [*key, bucket]).withColumn(name, F.col(name) + F.col("_before")).drop("_before")


def numbered(df: DataFrame, key: list[str], order: list[str], bucket: Column, name: str = "i") -> DataFrame:
    """Zero-based position by ``order`` within ``key``.

    ``bucket`` must not decrease along the order (a day of a time stamp, a block of iterations). Rows are numbered within
    (key, bucket) and offset by the count of earlier buckets: the sort is spread over buckets, and only one row per
    bucket meets in a task.
    """
    marked = df.withColumn("_bucket", bucket)
    counts = marked.groupBy(*key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = F.row_number().over(Window.partitionBy(*key, "_bucket").orderBy(*order)) - 1
    return marked.join(counts, [*key, "_bucket"]).withColumn(name, inside + F.col("_before")).drop("_bucket", "_before")
