"""Clusters of nearby points: a graph of cells, and connected components by label propagation with pointer jumping.

No join is broadcast: cells and labels grow with the points, and the driver would hold them anew in each round. Each round
costs the driver several plans and jobs, so the components of few links are found by one task instead.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from tidemark.operators.nearest import nearest

#: Points of the smaller of two neighbouring cells up to which all pairs of both are tried.
FEW = 32
#: Links up to which one task finds their components; more go by rounds of joins.
FEW_LINKS = 100_000
#: The side of a cell, in radii: a little below 1 / sqrt(2), so that rounding never makes its diagonal longer than the radius.
SIDE = (1 - 1e-9) / math.sqrt(2)


def proximity_links(points: DataFrame, key: list[str], node: str, x: str, y: str, radius: Column | float) -> DataFrame:
    """Links (key, u, v) that connect what points of the same key within the radius of each other connect.

    Their number is in proportion to the points, however dense the cloud. All points of a cell are within the radius of
    each other, so each is linked to the cell's smallest node; two cells at most two apart are linked once, if any of
    their points are near enough. Boxes and outmost points decide most of them; where the smaller cell has few points all
    pairs are tried, elsewhere its points look for their nearest one in the other cell. ``radius`` is a number or a column that is constant
    within the key. Points without coordinates have no links.
    """
    placed, cells, between = _cell_graph(points, key, node, x, y, radius)
    cell = [*key, "_cx", "_cy"]
    inner = placed.join(cells.select(*cell, "_first").hint("merge"), cell).filter("_id <> _first").select(*key, F.col("_first").alias("u"), F.col("_id").alias("v"))
    return inner.unionByName(between).select(*key, F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def proximity_roots(points: DataFrame, key: list[str], node: str, x: str, y: str, radius: Column | float) -> DataFrame:
    """(key, node, root): the smallest node of all points of the same key that chains of links reach.

    The components of :func:`proximity_links`, by way of those of the cells: a cell is one node, however many points it holds.
    """
    placed, cells, between = _cell_graph(points, key, node, x, y, radius)
    own = lambda n: F.struct(*key, F.col(n).alias("n"))
    root = components(cells.select(own("_first").alias("node")), between.select(own("u").alias("u"), own("v").alias("v")))
    cell = [*key, "_cx", "_cy"]
    rooted = cells.select(*cell, own("_first").alias("node")).join(root.hint("merge"), "node").select(*cell, F.col("root.n").alias("_root"))
    return placed.join(rooted.hint("merge"), cell, "left").select(*key, F.col("_id").alias(node), F.coalesce("_root", "_id").alias("root"))


def _cell_graph(points: DataFrame, key: list[str], node: str, x: str, y: str, radius: Column | float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All points with their cells (null without coordinates), the cells with their smallest node, and the links between cells by these."""
    r = F.lit(float(radius)) if isinstance(radius, (int, float)) else radius
    base = points.select(*key, F.col(node).alias("_id"), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), r.cast("double").alias("_r"))
    at = [F.when(F.col("_x").isNotNull() & F.col("_y").isNotNull(), F.floor(F.col(c) / (F.col("_r") * SIDE))).alias(n) for c, n in (("_x", "_cx"), ("_y", "_cy"))]
    every = base.select("*", *at).checkpoint()
    placed = every.filter("_cx IS NOT NULL AND _cy IS NOT NULL")
    cell = [*key, "_cx", "_cy"]
    box = [f(c).alias(f"_{n}{c[1]}") for c in ("_x", "_y") for n, f in (("lo", F.min), ("hi", F.max))]
    outmost = F.array(*[F.struct(p["_x"].alias("_x"), p["_y"].alias("_y")) for c in (("_x", "_y"), ("_y", "_x")) for p in (F.min(F.struct(*c)), F.max(F.struct(*c)))])
    cells = placed.groupBy(*cell).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"), F.first("_r").alias("_r"), outmost.alias("_out"), *box).checkpoint()

    # Half of the 24 cells around: each pair of cells meets once.
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-2, 3) for j in range(-2, 3) if (i, j) > (0, 0)])
    names = ("_cx", "_cy", "_first", "_n", "_lox", "_hix", "_loy", "_hiy")
    other = cells.select(*key, *[F.col(c).alias(f"{c}2") for c in (*names, "_out")])
    around = cells.withColumn("_s", F.explode(steps)).withColumn("_cx2", F.col("_cx") + F.col("_s.i")).withColumn("_cy2", F.col("_cy") + F.col("_s.j")).drop("_s")
    met = around.join(other.hint("merge"), [*key, "_cx2", "_cy2"])
    c = F.col
    gap = lambda d: F.greatest(c(f"_lo{d}") - c(f"_hi{d}2"), c(f"_lo{d}2") - c(f"_hi{d}"), F.lit(0.0))
    span = lambda d: F.greatest(c(f"_hi{d}2") - c(f"_lo{d}"), c(f"_hi{d}") - c(f"_lo{d}2"))
    r2 = c("_r") * c("_r")
    met = met.withColumn("_near", gap("x") * gap("x") + gap("y") * gap("y")).withColumn("_far", span("x") * span("x") + span("y") * span("y")).filter(c("_near") <= r2)
    close = lambda p, q: (p["_x"] - q["_x"]) * (p["_x"] - q["_x"]) + (p["_y"] - q["_y"]) * (p["_y"] - q["_y"]) <= r2
    met = met.withColumn("_sure", (c("_far") <= r2) | F.exists("_out", lambda p: F.exists("_out2", lambda q: close(p, q)))).drop("_out", "_out2").checkpoint()
    link = lambda df: df.select(*key, c("_first").alias("u"), c("_first2").alias("v"))
    sure = link(met.filter("_sure"))

    # The others: a is the smaller cell, b the larger one. Only points within the radius of the other's box matter.
    unsure = met.filter("NOT _sure")
    ends = lambda s: F.struct(*[c(f"{n}{s}").alias(n) for n in names])
    two = unsure.select(*key, "_r", F.when(c("_n") <= c("_n2"), ends("")).otherwise(ends("2")).alias("a"), F.when(c("_n") <= c("_n2"), ends("2")).otherwise(ends("")).alias("b")).withColumn("_pair", F.struct("a._first", c("b._first").alias("_other")))

    def reaching(pairs: DataFrame, own: str, far: str) -> DataFrame:
        out = lambda d: F.greatest(c(f"{far}._lo{d}") - c(f"_{d}"), c(f"_{d}") - c(f"{far}._hi{d}"), F.lit(0.0))
        rows = pairs.select(*key, "_pair", far, c(f"{own}._cx").alias("_cx"), c(f"{own}._cy").alias("_cy")).join(placed.hint("merge"), cell)
        return rows.filter(out("x") * out("x") + out("y") * out("y") <= c("_r") * c("_r")).select(*key, "_pair", "_id", "_x", "_y", "_r")

    few, many = two.filter(c("a._n") <= FEW), two.filter(c("a._n") > FEW)
    on = [*key, "_pair"]
    b = reaching(few, "b", "a").select(*on, c("_x").alias("_x2"), c("_y").alias("_y2"))
    d2 = (c("_x") - c("_x2")) * (c("_x") - c("_x2")) + (c("_y") - c("_y2")) * (c("_y") - c("_y2"))
    tried = reaching(few, "a", "b").join(b.hint("merge"), on).filter(d2 <= c("_r") * c("_r")).select(*on).distinct()
    if not many.isEmpty():
        q = reaching(many, "a", "b").withColumn("_query", F.struct(*on, "_id"))
        hit = nearest(q, reaching(many, "b", "a").drop("_r"), ["_x", "_y"], "_query", "_id", on)
        tried = tried.unionByName(hit.filter(c("distance") <= c("_r")).select(*on).distinct())
    outer = tried.select(*key, c("_pair._first").alias("u"), c("_pair._other").alias("v"))
    return every, cells, sure.unionByName(outer)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v, and both as plain keys) with ``part``, the number of the component that they belong to. All links come to one task."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    names = pa.concat_arrays([c for k in ("_ku", "_kv") for c in rows.column(k).chunks])
    codes = pc.dictionary_encode(names).indices.to_numpy()
    at = list(range(int(codes.max()) + 1))
    u, v = codes[: rows.num_rows].tolist(), codes[rows.num_rows :].tolist()

    def find(i: int) -> int:
        while at[i] != i:
            at[i] = i = at[at[i]]
        return i

    for a, b in zip(u, v, strict=True):
        a, b = find(a), find(b)
        at[max(a, b)] = min(a, b)
    part = pa.array(np.fromiter(map(find, u), "int64", len(u)))
    yield from pa.table({"u": rows["u"], "v": rows["v"], "part": part}).combine_chunks().to_batches()


def components(nodes: DataFrame, links: DataFrame, node: str = "node") -> DataFrame:
    """node, root: the smallest node that can be reached.

    Up to ``FEW_LINKS`` links are joined by one task; more by rounds, each of which is written to the checkpoint folder of the session.
    """
    links = links.select("u", "v").checkpoint()
    label = nodes.select(F.col(node).alias("node"), F.col(node).alias("root"))
    if links.count() <= FEW_LINKS:
        plain = lambda c: F.to_json(c) if isinstance(links.schema[c].dataType, StructType) else F.col(c)
        out = StructType([links.schema["u"], links.schema["v"], StructField("part", LongType())])
        parts = links.withColumn("_ku", plain("u")).withColumn("_kv", plain("v")).coalesce(1).mapInArrow(_parts, out)
        least = parts.withColumn("_least", F.min(F.least("u", "v")).over(Window.partitionBy("part")))
        found = least.select(F.explode(F.array("u", "v")).alias("_n"), "_least").groupBy("_n").agg(F.min("_least").alias("_least"))
        return label.join(found.hint("merge"), label["node"] == found["_n"], "left").select("node", F.coalesce("_least", "root").alias("root")).checkpoint()
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    label = label.checkpoint()
    while True:
        heard = both.join(label.withColumnRenamed("node", "v").hint("merge"), "v").groupBy("u").agg(F.min("root").alias("_m"))
        step = label.join(heard.hint("merge"), label["node"] == heard["u"], "left").select("node", F.least("root", F.coalesce("_m", "root")).alias("root"), F.col("root").alias("_old"))
        jump = step.select(F.col("node").alias("_n"), F.col("root").alias("_r2"))
        new = step.join(jump.hint("merge"), step["root"] == jump["_n"]).select("node", F.col("_r2").alias("root"), "_old").checkpoint()
        if new.filter(F.col("root") != F.col("_old")).isEmpty():
            return new.select("node", "root")
        label = new.select("node", "root")
