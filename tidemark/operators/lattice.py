"""Regular lattices: axes, spacing, completeness, arithmetic runs and averaging onto a grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values of one axis that are numbered together, on average.
STRETCH = 1 << 15


def lattice_axis(df: DataFrame, key: list[str], value: str, tolerance: float = 1e-4) -> DataFrame:
    """Distinct values, those with the same rounded multiple of the tolerance merged into the smallest."""
    return df.groupBy(*key, F.bround(F.col(value) / tolerance).cast("bigint").alias("_k")).agg(F.min(value).alias(value)).drop("_k")


def uniform_spacing(axis: DataFrame, key: list[str], value: str, tolerance: float = 1e-4) -> DataFrame:
    """Number of values, the mean step, the largest deviation from it, and whether all steps are equal (two values at least).

    The tolerance is relative to the mean step where that is above one.
    """
    steps = axis.withColumn("_d", F.lead(value).over(Window.partitionBy(*key).orderBy(value)) - F.col(value))
    out = steps.groupBy(*key).agg(F.count(F.lit(1)).alias("values"), F.avg("_d").alias("step"), F.max("_d").alias("_most"), F.min("_d").alias("_least"))
    deviation = F.greatest(F.col("_most") - F.col("step"), F.col("step") - F.col("_least"))
    out = out.withColumn("deviation", deviation).drop("_most", "_least")
    return out.withColumn("uniform", (F.col("values") >= 2) & (F.col("deviation") <= F.lit(tolerance) * F.greatest(F.lit(1.0), F.abs("step"))))


def lattice_missing(nodes: DataFrame, a: str, b: str, key: list[str] | None = None, stretch: int = STRETCH) -> DataFrame:
    """Nodes of the full lattice (all a times all b of a key) that are not there. Rows with a null in b or the key are no nodes; repeated ones count once.

    The values of b are dealt to stretches of some ``stretch`` values and numbered there. Per (key, a, stretch) only the
    numbers that are present meet, and their complement becomes rows: neither the full product nor all b of a key ever do.
    """
    by = key or ["_all"]
    rows = (nodes if key else nodes.withColumn("_all", F.lit(1))).select(*by, a, b).dropna(subset=[*by, b])
    values = rows.select(*by, b).distinct()
    parts = values.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / F.lit(stretch)).alias("_parts"))
    dealt = values.join(parts, by).withColumn("_part", F.pmod(F.xxhash64(b), F.col("_parts")))
    ranked = dealt.select(*by, b, "_part", F.row_number().over(Window.partitionBy(*by, "_part").orderBy(b)).alias("_rank"))
    sizes = ranked.groupBy(*by, "_part").agg(F.count(F.lit(1)).cast("int").alias("_size"))
    frame = rows.select(*by, a).distinct().join(sizes, by).select(*by, a, "_part", "_size", F.lit(None).cast("int").alias("_rank"))
    there = rows.join(ranked, [*by, b]).select(*by, a, "_part", F.lit(None).cast("int").alias("_size"), "_rank")
    held = frame.unionByName(there).groupBy(*by, a, "_part").agg(F.max("_size").alias("_size"), F.collect_set("_rank").alias("_have"))
    lost = held.filter(F.size("_have") < F.col("_size")).select(*by, a, "_part", F.explode(F.array_except(F.sequence(F.lit(1), F.col("_size")), F.col("_have"))).alias("_rank"))
    return lost.join(ranked, [*by, "_part", "_rank"]).select(*(key or []), a, b)


def inside_body(coords: list[Column], half_widths: list[float], tolerance: float = 1e-6) -> Column:
    out = F.lit(True)
    for c, h in zip(coords, half_widths, strict=True):
        out = out & (F.abs(c) <= F.lit(h + tolerance))
    return out


def unexplained(missing: DataFrame, coords: list[Column], half_widths: list[float], tolerance: float = 1e-6) -> DataFrame:
    """Missing nodes that no body covers."""
    return missing.filter(~inside_body(coords, half_widths, tolerance))


def bin_average(df: DataFrame, axes: dict[str, tuple[float, float]], *values: str) -> DataFrame:
    """Averages of scattered rows over the cells of a grid given by origin and step of each axis."""
    cells = [F.floor((F.col(c) - o) / s).cast("bigint").alias(f"{c}_cell") for c, (o, s) in axes.items()]
    return df.groupBy(*cells).agg(F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(v) for v in values])


def arithmetic_runs(df: DataFrame, key: list[str], order: str, value: str, least: int = 3) -> DataFrame:
    """Maximal runs of neighbouring rows whose values progress by a constant step: first and last place, length, start, step."""
    w = Window.partitionBy(*key).orderBy(order)
    rows = df.withColumn("_d", F.col(value) - F.lag(value).over(w)).withColumn("_p", F.lag("_d").over(w))
    # a new run starts where the step changes; its first difference belongs to the row before
    rows = rows.withColumn("_new", F.when(F.col("_d").isNull() | F.col("_p").isNull() | (F.col("_d") != F.col("_p")), 1).otherwise(0))
    rows = rows.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).filter(F.col("_d").isNotNull())
    out = rows.groupBy(*key, "_run").agg(F.min(order).alias("_o"), F.max(order).alias("last"), (F.count(F.lit(1)) + 1).alias("length"), F.min_by(value, order).alias("_v"), F.first("_d").alias("step"))
    return out.filter(F.col("length") >= least).select(*key, F.col("last"), "length", (F.col("_v") - F.col("step")).alias("start"), "step")


def plane_integral(df: DataFrame, key: list[str], product: Column, cell_area: float) -> DataFrame:
    return df.groupBy(*key).agg((F.sum(product) * cell_area).alias("integral"))


def threshold_extent(df: DataFrame, key: list[str], x: str, value: str, limit: float = 0.0) -> DataFrame:
    """Farthest x where the value is below the limit, and the first x at which it crosses the limit upwards, linear between rows."""
    order = Window.partitionBy(*key).orderBy(x)
    rows = df.withColumn("_x0", F.lag(x).over(order)).withColumn("_v0", F.lag(value).over(order))
    cross = F.when((F.col("_v0") < limit) & (F.col(value) >= limit), F.col("_x0") + (F.col(x) - F.col("_x0")) * (F.lit(limit) - F.col("_v0")) / (F.col(value) - F.col("_v0")))
    return rows.groupBy(*key).agg(F.max(F.when(F.col(value) < limit, F.col(x))).alias("farthest"), F.min(cross).alias("first_crossing"))
