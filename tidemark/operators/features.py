"""Feature extraction from point clouds: stations, relative thresholds, clusters, tracks and their summaries."""

from __future__ import annotations

import math
from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import ranks
from tidemark.operators.graph import FEW_LINKS, components, proximity_roots
from tidemark.operators.ordered import numbered
from tidemark.session import stored

#: Tolerance of tracking, constant and share of the gap, and the longest gap.
TRACK_BASE, TRACK_SLOPE, TRACK_GAP = 0.03, 0.35, 0.201


def station_bin(cloud: DataFrame, stations: list[float], width: float, x: str = "x") -> DataFrame:
    """Rows within half a width of a station, both ends closed: a row on an edge belongs to both stations. No join: the stations that a row meets are computed from a literal array."""
    centres = F.array(*[F.lit(float(s)) for s in stations])
    near = F.filter(centres, lambda c: F.abs(F.col(x) - c) <= F.lit(width / 2))
    return cloud.withColumn("station", F.explode(near))


def cut(cloud: DataFrame, least: Column | float, z: str = "z") -> DataFrame:
    """The cloud above a height. It comes before the largest value of a station is taken, or that may lie below the cut."""
    return cloud.filter(F.col(z) >= least)


def above_floor(cloud: DataFrame, floor: float, q: str) -> DataFrame:
    """What an export keeps: rows of at least a floor, a filter that reaches the scan."""
    return cloud.filter(F.col(q) >= F.lit(floor))


def station_sum(clusters: DataFrame, key: list[str], side: Column, value: str) -> DataFrame:
    """Sum over all clusters of either side: it does not depend on how points fell into clusters."""
    return clusters.groupBy(*key).agg(F.sum(F.when(side > 0, F.col(value)).otherwise(0.0)).alias("positive"), F.sum(F.when(side < 0, F.col(value)).otherwise(0.0)).alias("negative"))


def common_keys(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Keys that both tables have."""
    return a.select(*key).intersect(b.select(*key))


def relative_threshold(df: DataFrame, key: list[str], value: str, beta: float) -> DataFrame:
    """Rows of at least beta times the largest value of their key; keys without a positive value have none."""
    peak = F.max(value).over(Window.partitionBy(*key))
    return df.withColumn("peak", peak).filter((F.col("peak") > 0) & (F.col(value) >= F.lit(beta) * F.col("peak")))


def sweep_beta(df: DataFrame, key: list[str], value: str, betas: list[float]) -> DataFrame:
    """As :func:`relative_threshold` for several thresholds in one pass."""
    peak = F.max(value).over(Window.partitionBy(*key))
    rows = df.withColumn("peak", peak).filter(F.col("peak") > 0)
    return rows.withColumn("beta", F.explode(F.filter(F.array(*[F.lit(float(b)) for b in betas]), lambda b: F.col(value) >= b * F.col("peak"))))


def with_sense(df: DataFrame, value: str) -> DataFrame:
    """sense +1 or -1 by the sign of ``value``; zeros are dropped."""
    return df.withColumn("sense", F.signum(value).cast("int")).filter(F.col("sense") != 0)


def link_radius(df: DataFrame, key: list[str], volume: str, factor: float) -> DataFrame:
    """Factor times the median edge length of the cells of a key."""
    edges = ranks.median(df.select(*key, F.cbrt(volume).alias("_edge")), key, "_edge", "_middle")
    return edges.select(*key, (F.lit(factor) * F.col("_middle")).alias("link_radius"))


def clustered(points: DataFrame, key: list[str], node: str, y: str, z: str, volume: str, factor: float) -> DataFrame:
    """Points with the cluster they belong to: the smallest node of all points of the same key that chains of links reach.

    A point may belong to several keys (an edge of two stations): it is clustered in each on its own.
    """
    radius = link_radius(points, key, volume, factor)
    rows = points.join(radius, key)
    root = proximity_roots(rows, key, node, y, z, F.col("link_radius"))
    return rows.join(root.withColumnRenamed("root", "cluster"), [*key, node])


def cluster_summary(rows: DataFrame, key: list[str], weight: Column, volume: Column, q: str, node: str, coords: list[str], thickness: float, floor: float = 0.0) -> DataFrame:
    """Per cluster: circulation, weighted centroid, effective radius, peak row and its offset from the centroid; weak clusters are dropped.

    ``weight`` is signed (a vorticity); centroids weigh with its magnitude times the volume. The first of equal peaks counts.
    """
    w = F.abs(weight) * volume
    peak = F.max_by(F.struct(*coords, q), F.struct(F.col(q), -F.col(node)))
    out = rows.groupBy(*key).agg(
        (F.sum(weight * volume) / thickness).alias("circulation"), *[(F.sum(w * F.col(c)) / F.sum(w)).alias(f"{c}_mean") for c in coords],
        F.sqrt(F.sum(volume) / thickness / F.lit(math.pi)).alias("effective_radius"), F.count(F.lit(1)).alias("cells"), peak.alias("_peak"),
    )
    off = F.sqrt(sum(((F.col(f"_peak.{c}") - F.col(f"{c}_mean")) ** 2 for c in coords), F.lit(0.0)))
    out = out.withColumn("peak", F.col(f"_peak.{q}")).withColumn("offset", F.when(F.col("effective_radius") > 0, off / F.col("effective_radius"))).drop("_peak")
    return out.filter(F.abs("circulation") >= floor)


def argmax_row(df: DataFrame, key: list[str], value: str, columns: list[str], tie: str) -> DataFrame:
    """The row with the largest value of each key; the smallest ``tie`` wins."""
    row = F.max_by(F.struct(value, tie, *columns), F.struct(F.col(value), -F.col(tie)))
    return df.groupBy(*key).agg(row.alias("_r")).select(*key, *[F.col(f"_r.{c}").alias(c) for c in [value, tie, *columns]])


def track_links(clusters: DataFrame, key: list[str], base: float = TRACK_BASE, slope: float = TRACK_SLOPE, longest: float = TRACK_GAP) -> DataFrame:
    """Greedy tracking of clusters (x, y, z, sense, circulation) over the stations of a case: column ``track``.

    Strongest first within a station (then by y and z), nearest last centroid of the same sense, within a tolerance that
    grows with the gap; tracks are numbered in the order in which they begin. A choice depends on those before it, but
    only among clusters that chains of possible links connect. So each case is cut into such neighbourhoods, by way of a
    graph of occupied cells as wide as the longest link, and these are tracked apart: the result is that of the case as a whole.
    """
    wide = base + slope * longest
    corner = ("_i", "_j", "_k")
    place = ["x", "_strength", "y", "z"]
    at = [F.floor(F.col(c) / w).alias(n) for n, c, w in zip(corner, "xyz", (longest, wide, wide), strict=True)]
    # Written, since the cells and the rows are both made of it.
    rows = stored(clusters.select("*", (-F.abs("circulation")).alias("_strength"), F.struct(*key, "sense", *at).alias("_cell")), "clusters")
    cells = rows.select(F.col("_cell").alias("node")).distinct().checkpoint()
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k).alias("k")) for i in (0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1) if (i, j, k) > (0, 0, 0)])
    beside = F.struct(*[F.col(f"node.{c}").alias(c) for c in [*key, "sense"]], *[(F.col(f"node._{c}") + F.col(f"_s.{c}")).alias(f"_{c}") for c in "ijk"])
    near = cells.withColumn("_s", F.explode(steps)).select(F.col("node").alias("u"), beside.alias("v")).join(cells.withColumnRenamed("node", "v"), "v")
    root = components(cells, near.select("u", "v"), "node").select(F.col("node").alias("_cell"), *[F.col(f"root.{c}").alias(c) for c in corner])
    # A cell has the key and the sense of its rows, so plain columns tell a neighbourhood: of a struct, pandas would make an object per row.
    rows = rows.join(F.broadcast(root) if root.count() <= FEW_LINKS else root, "_cell").drop("_cell")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(place, kind="stable").reset_index(drop=True)
        track = greedy_tracks(*(pdf[c].to_numpy(float) for c in "xyz"), base, slope, longest)
        return pdf.assign(_track=track, _begins=~pd.Series(track).duplicated())

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", _track bigint, _begins boolean"
    # A few large neighbourhoods would be put into a few tasks by their bytes, but it is their rows that take time.
    tasks = 8 * rows.sparkSession.sparkContext.defaultParallelism
    apart = rows.repartition(tasks, *key, "sense", *corner).groupBy(*key, "sense", *corner).applyInPandas(one, schema)
    apart = stored(apart.withColumn("_root", F.struct(*key, "sense", *corner)).drop(*corner), "apart")
    # Tracks that begin with equal clusters lie in one neighbourhood, where their numbers follow the order.
    first = numbered(apart.filter("_begins").select(*key, "_root", *place, "sense", "_track"), key, [*place, "sense", "_track"], F.col("x"), "track")
    first = first.select("_root", "_track", F.col("track").cast("bigint").alias("track"))
    return apart.join(first.hint("merge"), ["_root", "_track"]).select(*clusters.columns, "track")


#: Clusters of a station, and ends of tracks, from which on the ends are put in order first.
STATION, ENDS = 8, 64


def greedy_tracks(x: np.ndarray, y: np.ndarray, z: np.ndarray, base: float, slope: float, longest: float) -> np.ndarray:
    """Track of each cluster of a neighbourhood, all of one sense and in the order in which they choose.

    Only ends of tracks within the longest gap are held, and a station's clusters look for theirs in ordered strips
    (:class:`_Ends`), not among all. Of equally near ends that of the first track is taken.
    """
    track = np.empty(len(x), "int64")
    count, i = 0, 0
    hx, hy, hz, ht = (np.empty(0, t) for t in (float, float, float, "int64"))
    whole = np.isfinite(x) & np.isfinite(y) & np.isfinite(z)
    while i < len(x):
        j = int(np.searchsorted(x, x[i], "right")) if x[i] == x[i] else i + 1
        gap = x[i] - hx
        held = (gap > 0) & (gap <= longest)
        hx, hy, hz, ht, tolerance = hx[held], hy[held], hz[held], ht[held], (base + slope * gap)[held]
        free = np.ones(len(ht), bool)
        ends = _Ends(hy, hz, tolerance) if j - i >= STATION and len(ht) >= ENDS else None
        for r in range(i, j):
            best = -1
            if ends:
                best = ends.take(float(y[r]), float(z[r])) if whole[r] else -1
            elif len(ht) and whole[r]:
                d = np.hypot(y[r] - hy, z[r] - hz)
                d[~free | (d > tolerance)] = np.inf
                best = int(d.argmin())
                best = best if d[best] < np.inf else -1
            if best >= 0:
                free[best] = False
                track[r] = ht[best]
            else:
                track[r] = count
                count += 1
        new = np.arange(i, j)[whole[i:j]]
        hx, hy, hz, ht = (np.concatenate([old[free], now[new]]) for old, now in ((hx, x), (hy, y), (hz, z), (ht, track)))
        order = ht.argsort(kind="stable")
        hx, hy, hz, ht, i = hx[order], hy[order], hz[order], ht[order], j
    return track


class _Ends:
    """Ends of tracks, of which the nearest free one within its tolerance is taken again and again.

    Ends of one tolerance lie in strips of z, those of a strip in order of y. From a place on, the nearest free end of a
    strip to either side comes first; taken ones are skipped by links that are shortened on the way. Equal ends are one.
    """

    def __init__(self, y: np.ndarray, z: np.ndarray, tolerance: np.ndarray):
        kinds = np.unique(tolerance)
        kind = np.searchsorted(kinds, tolerance) if len(kinds) <= 8 else np.searchsorted(np.quantile(tolerance, np.arange(1, 8) / 8), tolerance)
        strip = np.zeros(len(y), "int64")
        for k in np.unique(kind):
            own = kind == k
            levels = np.unique(z[own])
            many = max(1, math.isqrt(int(own.sum()) // 4))
            if len(levels) > max(many, 16):
                levels = np.unique(np.quantile(levels, np.arange(many) / many, method="lower"))
            strip[own] = np.searchsorted(levels, z[own], "right")
        order = np.lexsort((np.arange(len(y)), tolerance, z, y, strip, kind))
        y, z, tolerance, strip, kind = y[order], z[order], tolerance[order], strip[order], kind[order]
        cut = np.ones(len(y), bool)
        cut[1:] = (y[1:] != y[:-1]) | (z[1:] != z[:-1]) | (tolerance[1:] != tolerance[:-1]) | (strip[1:] != strip[:-1]) | (kind[1:] != kind[:-1])
        start = np.flatnonzero(cut)
        self.ends, self.at, self.stop = order.tolist(), start.tolist(), [*start[1:].tolist(), len(y)]
        self.y, self.z, self.tolerance = y[start].tolist(), z[start].tolist(), tolerance[start].tolist()
        n = len(start)
        self.right, self.left = list(range(n + 1)), list(range(n + 1))  # of place k: k if it is free; left is shifted by one
        edge = np.flatnonzero(np.concatenate([[True], (strip[start][1:] != strip[start][:-1]) | (kind[start][1:] != kind[start][:-1])]))
        self.kinds: list[tuple[float, list[float], list[tuple[int, int, float, float]]]] = []
        of = kind[start]
        for lo, hi in zip(edge.tolist(), [*edge[1:].tolist(), n], strict=True):
            if not lo or of[lo] != of[lo - 1]:
                self.kinds.append((0.0, [], []))
            most, tops, strips = self.kinds.pop()
            strips.append((lo, hi, min(self.z[lo:hi]), max(self.z[lo:hi])))
            self.kinds.append((max(most, *self.tolerance[lo:hi], 0.0), [*tops, strips[-1][3]], strips))

    @staticmethod
    def _free(links: list[int], k: int) -> int:
        while links[k] != k:
            links[k] = k = links[links[k]]
        return k

    def take(self, y: float, z: float) -> int:
        """Number of the end that is taken, or -1. The bounds are a little wide, so that rounding never hides an end or a tie."""
        best, where = (math.inf, -1), -1
        for most, tops, strips in self.kinds:
            middle = bisect_left(tops, z)
            for way in (range(middle, len(strips)), range(middle - 1, -1, -1)):
                for s in way:
                    lo, hi, least, top = strips[s]
                    off = max(least - z, z - top, 0.0)
                    far = min(best[0], most) * (1 + 1e-9)
                    if off > far:
                        break
                    p = bisect_left(self.y, y, lo, hi)
                    for links, shift, step in ((self.right, 0, 1), (self.left, 1, -1)):
                        k = self._free(links, p) - shift
                        wide = far * far - off * off
                        while lo <= k < hi and (self.y[k] - y) * (self.y[k] - y) <= wide * (1 + 1e-9):
                            d = float(np.hypot(y - self.y[k], z - self.z[k]))
                            if d <= self.tolerance[k] and (d, self.ends[self.at[k]]) < best:
                                best, where = (d, self.ends[self.at[k]]), k
                                far = min(d, most) * (1 + 1e-9)
                                wide = far * far - off * off
                            k = self._free(links, k + shift + step) - shift
        if where >= 0:
            self.at[where] += 1
            if self.at[where] == self.stop[where]:
                self.right[where], self.left[where + 1] = where + 1, where
        return best[1]


def long_tracks(tracks: DataFrame, key: list[str], least: int = 3) -> DataFrame:
    """Tracks with enough stations; ``fragments`` counts the others of the case."""
    n = tracks.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*key, "track")))
    short = F.size(F.collect_set(F.when(F.col("_n") < least, F.col("track"))).over(Window.partitionBy(*key)))
    return n.withColumn("fragments", short).filter(F.col("_n") >= least).drop("_n")


def track_summary(rows: DataFrame, key: list[str], x: str, y: str, z: str, strength: str) -> DataFrame:
    """Extent, count, mean and last strength; with 3 or more rows the ray through the origin, mean distance to it and slope of the strength."""
    ray = lambda c: F.sum(F.col(x) * F.col(c)) / F.sum(F.col(x) * F.col(x))
    per = rows.groupBy(*key).agg(F.min(x).alias("x_first"), F.max(x).alias("x_last"), F.count(F.lit(1)).alias("n"), F.avg(strength).alias("strength_mean"), F.max_by(strength, x).alias("strength_last"), ray(y).alias("dy_dx"), ray(z).alias("dz_dx"), F.regr_slope(strength, x).alias("dstrength_dx"))
    far = F.sqrt((F.col(y) - F.col("_a") * F.col(x)) ** 2 + (F.col(z) - F.col("_b") * F.col(x)) ** 2)
    rest = rows.join(per.select(*key, F.col("dy_dx").alias("_a"), F.col("dz_dx").alias("_b")), key).groupBy(*key).agg(F.avg(far).alias("ray_distance"))
    out = per.join(rest, key)
    long = F.col("n") >= 3
    return out.select(*key, "x_first", "x_last", "n", "strength_mean", "strength_last", *[F.when(long, F.col(c)).alias(c) for c in ("dy_dx", "dz_dx", "dstrength_dx", "ray_distance")])


def symmetry_profile(df: DataFrame, side: str, sides: tuple[str, str], x: str, value: str, downstream: float, digits: int = 4) -> DataFrame:
    """Relative difference of two sides at equal rounded x."""
    rows = df.filter(F.col(side).isin(*sides)).groupBy(F.round(x, digits).alias("x")).agg(F.sum(F.when(F.col(side) == sides[0], F.col(value))).alias("a"), F.sum(F.when(F.col(side) == sides[1], F.col(value))).alias("b"))
    both = rows.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    diff = both.withColumn("difference", F.abs(F.abs("a") - F.abs("b")) / F.greatest(F.abs("a"), F.abs("b"), F.lit(1e-30)))
    largest = F.max_by("x", F.struct(F.col("difference"), -F.col("x"))).alias("largest_at")
    out = diff.agg(F.count(F.lit(1)).alias("stations"), F.max("difference").alias("largest"), largest)
    for part, name in ((diff, "middle"), (diff.filter(F.col("x") >= downstream), "middle_downstream")):
        out = out.join(F.broadcast(ranks.median(part.select("difference"), [], "difference", name)), how="cross")  # one row each
    return out


def rank_label(df: DataFrame, side: list[str], sense: str, strength: str, tie: str) -> DataFrame:
    """label: primary (strongest of a side), secondary (strongest of the other sense), extra_k (the others in order)."""
    order = Window.partitionBy(*side).orderBy(F.col(strength).desc(), tie)
    rows = df.withColumn("_r", F.row_number().over(order)).withColumn("_p", F.first(sense).over(order))
    rows = rows.withColumn("_s", F.min(F.when(F.col(sense) != F.col("_p"), F.col("_r"))).over(Window.partitionBy(*side)))
    extra = F.col("_r") - 1 - F.when(F.col("_s") < F.col("_r"), 1).otherwise(0)
    label = F.when(F.col("_r") == 1, "primary").when(F.col("_r") == F.col("_s"), "secondary").otherwise(F.concat(F.lit("extra_"), extra.cast("string")))
    return rows.withColumn("label", label).drop("_r", "_p", "_s")


def split_verdict(df: DataFrame, key: list[str], side: str, strength: str, tolerance: float) -> DataFrame:
    """Whether the top two clusters of the weaker side add up to the strongest of the other."""
    order = Window.partitionBy(*key, side).orderBy(F.col(strength).desc())
    top = df.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= 2)
    per = top.groupBy(*key, side).agg(F.max(strength).alias("first"), F.sum(strength).alias("two"), F.count(F.lit(1)).alias("n"))
    both = per.groupBy(*key).agg(F.max("first").alias("high"), F.min_by("two", "first").alias("low_two"), F.min_by("n", "first").alias("low_n"))
    return both.withColumn("split", (F.col("low_n") == 2) & (F.abs(F.col("low_two") - F.col("high")) <= F.lit(tolerance) * F.col("high")))


def coverage(df: DataFrame, key: list[str], inside: Column, value: str) -> DataFrame:
    """Share of the value inside a region, null if there is none at all."""
    return df.groupBy(*key).agg(F.try_divide(F.sum(F.when(inside, F.col(value)).otherwise(0)), F.sum(value)).alias("coverage"))


def principal_axis(df: DataFrame, key: list[str], x: str, y: str) -> DataFrame:
    """Angle in degrees of the long axis of a cloud and its planarity (1 - small over large eigenvalue)."""
    per = df.groupBy(*key).agg(F.var_samp(x).alias("_a"), F.var_samp(y).alias("_b"), F.covar_samp(x, y).alias("_c"))
    mid, half = (F.col("_a") + F.col("_b")) / 2, F.sqrt(((F.col("_a") - F.col("_b")) / 2) ** 2 + F.col("_c") * F.col("_c"))
    return per.select(*key, (F.degrees(F.atan2(2 * F.col("_c"), F.col("_a") - F.col("_b"))) / 2).alias("axis_angle"), F.when(mid + half > 0, 1 - (mid - half) / (mid + half)).alias("planarity"))


def mean_angle(df: DataFrame, key: list[str], angle: Column) -> DataFrame:
    """Direction of the mean vector, in degrees, and its length."""
    c, s = F.avg(F.cos(angle)), F.avg(F.sin(angle))
    return df.groupBy(*key).agg(F.degrees(F.atan2(s, c)).alias("mean_angle"), F.sqrt(c * c + s * s).alias("resultant"))


def lobes(df: DataFrame, key: list[str], w: str, y: str, z: str, share: float = 0.1) -> DataFrame:
    """Weighted centroids of w > share max and w < -share max, max being the largest magnitude."""
    peak = F.max(F.abs(w)).over(Window.partitionBy(*key))
    rows = df.withColumn("_p", peak * share).withColumn("lobe", F.when(F.col(w) > F.col("_p"), "positive").when(F.col(w) < -F.col("_p"), "negative")).filter(F.col("lobe").isNotNull())
    weight = F.abs(w)
    return rows.groupBy(*key, "lobe").agg((F.sum(weight * F.col(y)) / F.sum(weight)).alias("y_mean"), (F.sum(weight * F.col(z)) / F.sum(weight)).alias("z_mean"), F.count(F.lit(1)).alias("n"))
