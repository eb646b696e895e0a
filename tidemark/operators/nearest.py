"""Exact nearest neighbours without a search radius.

Points are put into a tree of cells that are cut only where they hold more than ``LEAF`` points, so dense places get
small cells and empty ones none. All queries go down the tree level by level: a query keeps the cells that may hold its
nearest point, those whose box is not farther away than the farthest corner of the best box so far. What is left are a few
leaves around the query, however far away its nearest point is. Each level is one equi-join of the queries' open cells
with their children and one minimum per query.

Boxes are tight (least and largest coordinates of the points inside), and distances to them are formed in the same order
of operations as those between points, so rounding never excludes the nearest point, nor a tie.

Cells have the same side in all dimensions, so a cloud that is long in one of them does not give a query many flat cells
that are as near as its own. Queries at the same position go down as one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LEAF = 32
#: Cells of a level that are broadcast to the queries; deeper levels are joined by shuffle.
FEW_CELLS = 20_000
#: Halvings of the extent after which a cell is not cut any more.
HALVINGS = 50


def _finite(dims: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(d).isNotNull() & ~F.isnan(d) & (F.abs(d) < float("inf")) for d in dims])


def _total(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [p * p for p in parts])


def cell_tree(points: DataFrame, key: list[str], dims: list[str]) -> tuple[list[tuple[DataFrame, int]], DataFrame]:
    """Cells of each level with their number, and the points with the leaf they lie in. ``points``: key, dims, _pid; distinct positions.

    A cell has its level, place, parent's place, box and whether it is cut further. The cells of level 0 are whole keys.
    """
    halved = 2 if len(dims) <= 2 else 1  # halvings of each dimension from a level to the next
    box = [f(d).alias(f"_{n}{d}") for d in dims for n, f in (("lo", F.min), ("hi", F.max))]
    root = points.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *box)
    levels: list[tuple[DataFrame, int]] = []
    open_ = points.join(root.select(*key, *[F.col(f"_{n}{d}").alias(f"_{n}0{d}") for d in dims for n in ("lo", "hi")]), key) if key else points.crossJoin(
        F.broadcast(root.select(*[F.col(f"_{n}{d}").alias(f"_{n}0{d}") for d in dims for n in ("lo", "hi")]))
    )  # one row
    widest = reduce(lambda a, b: F.when(a >= b, a).otherwise(b), [F.col(f"_hi0{d}") - F.col(f"_lo0{d}") for d in dims])
    settled = []
    for level in range(0, HALVINGS // halved + 1):
        parts = float(2 ** (halved * level))
        place = lambda d: F.least(F.floor((F.col(d) - F.col(f"_lo0{d}")) / widest * parts), F.lit(int(parts) - 1))  # noqa: B023, E731
        own = [F.when(widest > 0, place(d)).otherwise(F.lit(0)).cast("bigint").alias(f"_c{d}") for d in dims]
        placed = open_.drop(*[f"_c{d}" for d in dims]).withColumns({f"_c{d}": c for d, c in zip(dims, own, strict=True)})
        at = [*key, *[f"_c{d}" for d in dims]]
        last = level == HALVINGS // halved
        cells = placed.groupBy(*at).agg(F.count(F.lit(1)).alias("_n"), *box).withColumn("_cut", F.lit(False) if last else F.col("_n") > LEAF)
        cells = cells.withColumns({f"_u{d}": F.shiftright(f"_c{d}", halved) for d in dims}).drop("_n").checkpoint()
        levels.append((cells, cells.count()))
        marked = placed.join(cells.select(*at, "_cut"), at)
        settled.append(marked.filter(~F.col("_cut")).select(*at, F.lit(level).alias("_level"), "_pid", *[F.col(d).alias(f"_p{d}") for d in dims]))
        if cells.filter("_cut").isEmpty():
            break
        open_ = marked.filter("_cut").drop("_cut").checkpoint()
    return levels, reduce(DataFrame.unionByName, settled).checkpoint()


def nearest(queries: DataFrame, points: DataFrame, dims: list[str], query_id: str, point_id: str, key: list[str] | None = None) -> DataFrame:
    """The nearest point of the same key for each query: columns ``distance`` and ``nearest``, ties to the smallest id.

    Both are null where the key has no points, or where a coordinate of the query is null or not finite; such points are
    left out. Repeated points and queries cost nothing: each position of points stands for its smallest id, and each of
    queries is looked for once.
    """
    key = key or []
    p = points.filter(_finite(dims)).groupBy(*key, *[(F.col(d).cast("double") + F.lit(0.0)).alias(d) for d in dims]).agg(F.min(point_id).alias("_pid")).checkpoint()
    if p.isEmpty():
        kind = points.schema[point_id].dataType
        return queries.withColumn("distance", F.lit(None).cast("double")).withColumn("nearest", F.lit(None).cast(kind))
    levels, leaves = cell_tree(p, key, dims)
    spot = {f"_q{d}": F.col(d).cast("double") + F.lit(0.0) for d in dims}
    q = queries.filter(_finite(dims)).withColumns(spot).groupBy(*key, *spot).agg(F.min(query_id).alias("_qid")).checkpoint()
    lo, hi, at = (lambda d, n=n: F.col(f"_{n}{d}") for n in ("lo", "hi", "q"))
    least = _total([F.greatest(lo(d) - at(d), at(d) - hi(d), F.lit(0.0)) for d in dims])
    most = _total([F.greatest(at(d) - lo(d), hi(d) - at(d)) for d in dims])
    bound = Window.partitionBy("_qid")
    front, done = None, []
    for level, (cells, n) in enumerate(levels):
        side = F.broadcast(cells) if n <= FEW_CELLS else cells
        if front is None:
            met = q.join(side, key) if key else q.crossJoin(side)  # level 0: one cell per key
        else:
            children = side.withColumnsRenamed({f"_u{d}": f"_a{d}" for d in dims})
            met = front.join(children, [*key, *[f"_a{d}" for d in dims]])
        met = met.withColumn("_near", least).withColumn("_far", most)
        if front is not None:
            met = met.filter(F.col("_near") <= F.col("_best"))
        met = met.withColumn("_best", F.least(F.min("_far").over(bound), F.col("_best")) if front is not None else F.min("_far").over(bound)).filter(F.col("_near") <= F.col("_best"))
        here = [*key, "_qid", *[f"_q{d}" for d in dims], "_best", "_near", *[f"_c{d}" for d in dims]]
        done.append(met.filter(~F.col("_cut")).select(*here, F.lit(level).alias("_level")))
        front = met.filter("_cut").select(*key, "_qid", *[f"_q{d}" for d in dims], "_best", *[F.col(f"_c{d}").alias(f"_a{d}") for d in dims])
        if level % 3 == 2 and level + 1 < len(levels):
            front, done[-1] = front.checkpoint(), done[-1].checkpoint()
    # A leaf kept early may have been beaten by a box further down.
    kept = reduce(DataFrame.unionByName, done).withColumn("_best", F.min("_best").over(bound)).filter(F.col("_near") <= F.col("_best"))
    close = kept.join(leaves, [*key, "_level", *[f"_c{d}" for d in dims]])
    d2 = _total([at(d) - F.col(f"_p{d}") for d in dims])
    best = close.groupBy("_qid").agg(F.min(F.struct(d2.alias("d2"), "_pid")).alias("_b")).select("_qid", F.sqrt("_b.d2").alias("distance"), F.col("_b._pid").alias("nearest"))
    return queries.withColumns(spot).join(q.join(best, "_qid").drop("_qid"), [*key, *spot], "left").select(*queries.columns, "distance", "nearest")
