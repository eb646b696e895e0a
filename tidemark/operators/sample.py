"""Importance-weighted sampling without replacement and what is said about it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import hash_uniform


def importance_sample(df: DataFrame, keep: int, weight: Column, keys: list[str], seed: int = 42) -> DataFrame:
    """The ``keep`` rows with the largest ln(u) / w; rows without positive weight never come in. u is a hash of the keys, so the sample does not depend on partitioning."""
    rows = df.withColumn("weight", weight).filter(F.col("weight") > 0).withColumn("sample_key", F.ln(hash_uniform(*keys, seed=seed)) / F.col("weight"))
    return rows.orderBy(F.col("sample_key").desc(), *keys).limit(keep)


def totals(df: DataFrame, weight: Column, volume: Column, tracer: Column | None = None) -> DataFrame:
    """One row: rows, sum of the positive weights, sum of volume, rows without positive weight, and the bounds of ``tracer``."""
    positive = F.coalesce(weight > 0, F.lit(False))
    bounds = [] if tracer is None else [F.min(tracer).alias("tracer_min"), F.max(tracer).alias("tracer_max")]
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(positive, weight).otherwise(0.0)).alias("total_weight"), F.sum(volume).alias("total_volume"), F.count_if(~positive).alias("zero_weight"), *bounds)


def with_volume_weight(sample: DataFrame, total_weight: float, total_volume: float, volume: str = "volume") -> DataFrame:
    """Self-normalised weights: raw = W V / (n w), scaled so that they sum to the total volume. ``coverage``: the raw sum over the total."""
    every = Window.partitionBy()  # the sample has a fixed, small number of rows
    raw = F.lit(float(total_weight)) * F.col(volume) / (F.count(F.lit(1)).over(every) * F.col("weight"))
    rows = sample.withColumn("raw_weight", raw)
    whole = F.sum("raw_weight").over(every)
    return rows.withColumn("vol_weight", F.col("raw_weight") * F.lit(float(total_volume)) / whole).withColumn("coverage", whole / F.lit(float(total_volume)))


def estimate_integral(sample: DataFrame, *fields: str) -> DataFrame:
    return sample.agg(*[F.sum(F.col(f) * F.col("vol_weight")).alias(f"integral_{f}") for f in fields])


def concentration(df: DataFrame, weight: Column, volume: Column, marks: tuple[float, ...] = (0.001, 0.01, 0.05, 0.1, 0.25), bins: int = 4096) -> DataFrame:
    """For each mark the share of weight and of volume in that share of the rows, heaviest first (at least one row).

    Equal weights are taken together, and rows of one weight count in proportion. Running sums go over distinct weights
    within bins of about equally many distinct weights, however heavy the tail; only the totals of at most ``bins`` bins are added up in one task, and rows are
    never ordered as a whole.
    """
    per = df.groupBy(weight.cast("double").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum(volume).alias("v")).filter(F.col("w").isNotNull())
    edges = per.agg(F.approx_percentile("w", F.array(*[F.lit(k / 64) for k in range(1, 64)]), F.lit(bins)).alias("_edges"))
    coarse = F.size(F.filter("_edges", lambda e: e <= F.col("w")))  # quantiles, so no bin holds much more than others
    per = per.crossJoin(F.broadcast(edges)).withColumn("bin", coarse.cast("int")).drop("_edges")  # one row
    down = Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    whole = per.groupBy("bin").agg(F.sum("n").alias("bn"), F.sum(F.col("w") * F.col("n")).alias("bw"), F.sum("v").alias("bv"))
    whole = whole.select("bin", *[F.coalesce(F.sum(f"b{c}").over(down), F.lit(0)).alias(f"{c}_above") for c in "nwv"], *[F.sum(f"b{c}").over(every).alias(f"all_{c}") for c in "nwv"])
    inside = Window.partitionBy("bin").orderBy(F.col("w").desc()).rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c, above: F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(above)
    rows = per.join(F.broadcast(whole), "bin").withColumn("n0", so_far(F.col("n"), "n_above")).withColumn("w0", so_far(F.col("w") * F.col("n"), "w_above")).withColumn("v0", so_far(F.col("v"), "v_above"))
    rows = rows.withColumn("mark", F.explode(F.array(*[F.lit(float(m)) for m in marks]))).withColumn("k", F.greatest(F.lit(1), F.ceil(F.col("mark") * F.col("all_n") - 1e-9)))
    part = F.greatest(F.lit(0), F.least(F.col("k") - F.col("n0"), F.col("n")))
    at = rows.filter((F.col("n0") < F.col("k")) & (F.col("n0") + F.col("n") >= F.col("k")))
    return at.select("mark", F.col("k").cast("bigint").alias("rows"), ((F.col("w0") + F.col("w") * part) / F.col("all_w")).alias("weight_share"), ((F.col("v0") + F.col("v") * part / F.col("n")) / F.col("all_v")).alias("volume_share"))


def stride_sample(df: DataFrame, every: int, most: int, order: list[str]) -> DataFrame:
    """Every k-th row in order, up to a number of rows."""
    return df.withColumn("_i", F.row_number().over(Window.orderBy(*order)) - 1).filter((F.col("_i") % every == 0) & (F.col("_i") < every * most)).drop("_i")
