"""Nearest neighbours, mirror pairing, ranks and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.nearest import nearest
from tidemark.operators.ranks import at_ranks


def nearest_within(queries: DataFrame, points: DataFrame, dims: list[str], radius: float, query_id: str, point_id: str, key: list[str] | None = None) -> DataFrame:
    """The nearest point of each query within the radius (null if there is none), ties to the smallest id.

    Found by :func:`nearest`, whose cost does not depend on how many points lie within the radius.
    """
    hit = nearest(queries, points, dims, query_id, point_id, key)
    near = F.col("distance") <= radius
    return hit.withColumns({"distance": F.when(near, F.col("distance")), "nearest": F.when(near, F.col("nearest"))})


def mirror_pairs(cloud: DataFrame, cell_id: str, axis: str, dims: list[str], size: str, on_plane: float = 1e-9) -> DataFrame:
    """Every cell off the plane with the nearest cell of the other side to its mirror image.

    outcome: paired (within the larger of both cell sizes, sizes in a ratio of at most the root of two), level_mismatch
    (near, but of another size), unpaired. delta: distance over the cell's own size. The nearest cell is found however far
    it is; it is null only where the other side has no cells. Cells within ``on_plane`` times the largest size lie on the
    plane.
    """
    largest = cloud.agg(F.max(size).alias("_largest"))
    off = cloud.crossJoin(F.broadcast(largest)).filter(F.abs(axis) > F.lit(on_plane) * F.col("_largest")).drop("_largest")  # one row
    query = off.withColumn("_side", -F.signum(axis)).withColumn(axis, -F.col(axis))
    hit = nearest(query, off.withColumn("_side", F.signum(axis)), dims, cell_id, cell_id, ["_side"])
    other = cloud.select(F.col(cell_id).alias("_oid"), F.col(size).alias("_osize"))
    rows = hit.join(other, hit["nearest"] == other["_oid"], "left").drop("_oid", "_side")
    reach = F.greatest(F.col(size), F.col("_osize"))
    delta = F.col("distance") / F.col(size)
    outcome = F.when(F.col("nearest").isNull() | (F.col("distance") > reach), "unpaired").when(F.abs(F.log2(F.col(size) / F.col("_osize"))) > 0.5, "level_mismatch").otherwise("paired")
    return rows.withColumn("delta", delta).withColumn("outcome", outcome).drop("_osize")


def outcome_counts(pairs: DataFrame, cells: int) -> DataFrame:
    """Counts per outcome, of cells on the plane and of cells that were looked for. On the plane and looked for add up to all cells."""
    n = lambda o: F.count_if(F.col("outcome") == o)
    return pairs.agg(F.lit(cells).cast("bigint").alias("cells"), F.count(F.lit(1)).alias("queried"), (F.lit(cells) - F.count(F.lit(1))).alias("on_plane"), n("paired").alias("paired"), n("level_mismatch").alias("level_mismatch"), n("unpaired").alias("unpaired"))


def nearest_rank(df: DataFrame, key: list[str], value: str, ranks: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Nearest-rank percentiles and the maximum, exact for groups of any size; null values don't count."""
    wanted = {f"p{round(100 * r):02d}": lambda n, r=r: F.greatest(F.ceil(F.lit(r) * n), F.lit(1)) for r in ranks}
    return at_ranks(df, key, value, wanted | {"largest": lambda n: n})


def histogram_fixed(df: DataFrame, value: Column, edges: list[float]) -> DataFrame:
    """Counts of half-open bins [edge, next), the last one open above; empty bins are listed, values below the first edge are bin -1."""
    place = (F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda e: e <= value)) - 1).cast("bigint")
    counts = df.filter(value.isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(-1, len(edges)).withColumnRenamed("id", "bin")
    return every.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")).filter((F.col("bin") >= 0) | (F.col("n") > 0))


def side_of(y: Column, dead: float = 0.0) -> Column:
    """1, -1, or 0 within the dead band about the plane."""
    return F.when(y > F.lit(dead), 1).when(y < F.lit(-dead), -1).otherwise(0)


def worst_balance(balance: DataFrame, key: str) -> DataFrame:
    """All keys together and the worst of them: n_positive, n_negative, sum_positive, sum_negative, imbalance, worst, worst_imbalance."""
    p, n = F.sum("sum_positive"), F.sum("sum_negative")
    worst = F.max(F.struct("imbalance", F.col(key).alias("k")))
    return balance.agg(F.sum("n_positive").alias("n_positive"), F.sum("n_negative").alias("n_negative"), p.alias("sum_positive"), n.alias("sum_negative"), (F.abs(p - n) / F.greatest(p, n, F.lit(1e-30))).alias("imbalance"), worst["k"].alias("worst"), worst["imbalance"].alias("worst_imbalance"))


def side_balance(df: DataFrame, key: list[str], side: Column, value: str) -> DataFrame:
    """Count and sum of both sides of each key and their relative difference, and which key is worst."""
    pos, neg = F.sum(F.when(side > 0, F.col(value)).otherwise(0)), F.sum(F.when(side < 0, F.col(value)).otherwise(0))
    per = df.groupBy(*key).agg(F.count_if(side > 0).alias("n_positive"), F.count_if(side < 0).alias("n_negative"), pos.alias("sum_positive"), neg.alias("sum_negative"))
    return per.withColumn("imbalance", F.abs(F.col("sum_positive") - F.col("sum_negative")) / F.greatest(F.abs("sum_positive"), F.abs("sum_negative"), F.lit(1e-30)))
