"""Differences between a base and a variant: scalars, files, pixels, and closures within one document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scalar_delta(base: DataFrame, variant: DataFrame, key: list[str], value: str = "value", digits: int = 7) -> DataFrame:
    """variant - base for keys on both sides, rounded, and relative to the base (null where the base is practically zero)."""
    b, v = base.select(*key, F.col(value).alias("base")), variant.select(*key, F.col(value).alias("variant"))
    d = F.col("variant") - F.col("base")
    return b.join(v, key).withColumn("delta", F.round(d, digits) + 0.0).withColumn("relative", F.when(F.abs("base") > 1e-9, d / F.abs("base")))


def manifest_drift(declared: DataFrame, present: DataFrame, path: str = "path", digest: str = "sha256") -> DataFrame:
    """missing, added, changed or same per path."""
    a, b = declared.select(path, F.col(digest).alias("_a")), present.select(path, F.col(digest).alias("_b"))
    status = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "added").when(F.col("_a") != F.col("_b"), "changed").otherwise("same")
    return a.join(b, path, "full").select(path, status.alias("drift"))


def unpaired_stems(files: DataFrame, key: list[str], stem: str, kind: str, kinds: tuple[str, str]) -> DataFrame:
    """Stems of which one of two kinds is absent, by one grouped pass instead of an outer join."""
    has = [F.bool_or(F.col(kind) == k) for k in kinds]
    per = files.filter(F.col(kind).isin(*kinds)).groupBy(*key, stem).agg(has[0].alias("_0"), has[1].alias("_1"))
    return per.filter(F.col("_0") != F.col("_1")).select(*key, stem, F.when(F.col("_0"), kinds[1]).otherwise(kinds[0]).alias("missing"))


def pixel_change(base: DataFrame, variant: DataFrame, image: str, pixels: str, threshold: int, excluded: Column | None = None) -> DataFrame:
    """Per image: pixels compared, share that changes by at least the threshold (and by more), and the largest change.

    ``pixels``: an array per image, in the same order on both sides; ``size_equal`` says whether it has the same length.
    The arrays are compared in place, so the join carries one row per image.
    """
    b, v = base.select(image, F.col(pixels).alias("_a")), variant.select(image, F.col(pixels).alias("_b"))
    both = b.join(v, image).withColumn("size_equal", F.size("_a") == F.size("_b"))
    change = F.filter(F.zip_with("_a", "_b", lambda x, y: F.abs(x - y)), lambda d: d.isNotNull())
    rows = both.withColumn("_d", change)
    n = F.size("_d")
    share = lambda c: F.size(F.filter("_d", c)) / n
    return rows.select(image, "size_equal", n.cast("bigint").alias("compared"), share(lambda d: d >= threshold).alias("changed"), share(lambda d: d > threshold).alias("changed_more"), F.array_max("_d").alias("largest"))


def runs(df: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """Maximal runs of equal neighbours: run number, value, length."""
    w = Window.partitionBy(*key).orderBy(*order)
    rows = df.withColumn("_new", F.when(F.lag(value).over(w).eqNullSafe(F.col(value)), 0).otherwise(1))
    rows = rows.withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*key, "run").agg(F.first(value).alias(value), F.count(F.lit(1)).alias("length"))


def split_closure(df: DataFrame, total: str, parts: list[str], tolerance: float = 1e-3) -> DataFrame:
    """Whether the parts add up to the total within a share of its magnitude."""
    gap = F.abs(F.col(total) - sum((F.col(p) for p in parts), F.lit(0.0)))
    return df.withColumn("gap", gap).withColumn("closed", gap <= F.lit(tolerance) * F.abs(total))


def energy_cumulative(df: DataFrame, key: list[str], order: list[Column], fraction: str) -> DataFrame:
    """Running sum of the fractions in order."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("cumulative", F.sum(fraction).over(w)).withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))


def three_way_equal(frames: list[DataFrame], columns: list[str]) -> DataFrame:
    """One row: whether one-row frames agree in all columns."""
    joined = None
    for i, f in enumerate(frames):
        one = f.select(*[F.col(c).alias(f"{c}_{i}") for c in columns])
        joined = one if joined is None else joined.crossJoin(one)
    same = [F.col(f"{c}_{i}").eqNullSafe(F.col(f"{c}_0")) for c in columns for i in range(1, len(frames))]
    return joined.select(*[F.col(f"{c}_0").alias(c) for c in columns], F.array_min(F.array(*same)).alias("agree"))
