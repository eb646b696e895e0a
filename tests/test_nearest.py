"""Nearest points without a radius, clusters of dense clouds and exact ranks, each against brute force."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import graph, nearest, neighbours, ranks


def clouds(rng):
    lattice = [(0.5 * i, 0.5 * j) for i in range(20) for j in range(20)]
    fine = [(20 + 0.05 * i, 0.05 * j) for i in range(20) for j in range(20)]
    dense = [(1e-6 * rng.random(), 1e-6 * rng.random()) for _ in range(500)]
    return {"two levels": lattice + fine, "dense beside empty": [*dense, (1000.0, 0.0), (-1000.0, 5.0)], "one place": [(3.0, 4.0)] * 100, "line": [(float(i), 7.0) for i in range(300)], "one": [(0.0, 0.0)]}


def brute(q, points):
    return min(((q[0] - x) * (q[0] - x) + (q[1] - y) * (q[1] - y), i) for i, (x, y) in enumerate(points))


def test_nearest_over_any_distance(spark):
    rng = random.Random(4)
    pts, qs, want = [], [], {}
    for name, cloud in clouds(rng).items():
        pts += [(name, i, x, y) for i, (x, y) in enumerate(cloud)]
        for _ in range(40):
            x, y = rng.choice(cloud)
            q = rng.choice([(x, y), (x + 0.25, y + 0.25), (rng.uniform(-2000, 2000), rng.uniform(-50, 50)), (rng.uniform(-3, 30), rng.uniform(-3, 30))])
            want[len(qs)] = brute(q, cloud)
            qs.append((name, len(qs), *q))
    pts += [("line", -5, None, 7.0), ("line", -6, float("nan"), 7.0), ("two levels", -1, float("inf"), 0.0)]
    qs += [("nobody", 10_001, 0.0, 0.0), ("line", 10_002, None, 0.0)]
    got = nearest.nearest(spark.createDataFrame(qs, "k string, id long, x double, y double"), spark.createDataFrame(pts, "k string, pid long, x double, y double"), ["x", "y"], "id", "pid", ["k"])
    rows = {r["id"]: (r["distance"], r["nearest"]) for r in got.collect()}
    assert len(rows) == len(qs) and rows[10_001] == rows[10_002] == (None, None)
    assert {i: rows[i] for i in want} == {i: (math.sqrt(d), j) for i, (d, j) in want.items()}


def test_nearest_in_space_and_without_points(spark, monkeypatch):
    monkeypatch.setattr(nearest, "FEW_CELLS", 3)  # levels joined by shuffle
    rng = random.Random(5)
    pts = [(i, *(rng.gauss(0, rng.choice((0.01, 1, 10))) for _ in range(3))) for i in range(700)]
    qs = [(i, *(rng.gauss(0, 5) for _ in range(3))) for i in range(80)]
    a, b = (spark.createDataFrame(r, "id long, x double, y double, z double") for r in (qs, pts))
    got = {r["id"]: r["nearest"] for r in nearest.nearest(a, b, ["x", "y", "z"], "id", "id").collect()}
    assert got == {q[0]: min((sum((u - v) ** 2 for u, v in zip(q[1:], p[1:], strict=True)), p[0]) for p in pts)[1] for q in qs}
    assert {r["nearest"] for r in nearest.nearest(a, b.limit(0), ["x", "y", "z"], "id", "id").collect()} == {None}


def test_mirror_of_two_levels(spark):
    """A lattice whose other half is twice as fine in one part and missing in another: all three outcomes."""
    rows = [(x, y, 1.0) for x in (0.5, 1.5, 2.5) for y in (0.5, 1.5, 2.5)]
    rows += [(-x, y, 1.0) for x in (0.5, 1.5) for y in (0.5, 1.5, 2.5) if (x, y) != (1.5, 2.5)] + [(-1.5 + dx, 2.5 + dy, 0.5) for dx in (-0.25, 0.25) for dy in (-0.25, 0.25)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, x double, y double, size double")
    got = {r["id"]: r for r in neighbours.mirror_pairs(df, "id", "x", ["x", "y"], "size").collect()}
    for i, (x, y, size) in enumerate(rows):
        d2, j = min(((-x - u) ** 2 + (y - v) ** 2, k) for k, (u, v, _) in enumerate(rows) if u * x < 0)
        far = math.sqrt(d2) > max(size, rows[j][2])
        assert got[i]["nearest"] == j
        assert got[i]["outcome"] == ("unpaired" if far else "paired" if abs(math.log2(size / rows[j][2])) <= 0.5 else "level_mismatch")
    assert {r["outcome"] for r in got.values()} == {"paired", "level_mismatch"} and got[6]["distance"] == 1.0


def roots(n, near):
    root = list(range(n))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(n):
        for j in range(i):
            if near(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("few", [0, 32])
def test_clusters_of_dense_and_sparse_clouds(spark, monkeypatch, few):
    monkeypatch.setattr(graph, "FEW", few)
    rng = random.Random(6)
    pts = [(rng.random(), rng.random()) for _ in range(150)] + [(5 + 0.01 * rng.random(), 0.01 * rng.random()) for _ in range(300)]
    pts += [(5.08 + 0.01 * rng.random(), 0.01 * rng.random()) for _ in range(200)] + [(0.1 * i, -3.0) for i in range(12)] + [(0.1 * i + 0.01, -4.0 - 0.1 * (i % 2)) for i in range(12)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)] + [(5000, None, 1.0)], "id long, x double, y double")
    links = graph.proximity_links(df, [], "id", "x", "y", 0.1).checkpoint()
    assert links.count() < 13 * len(pts)
    got = {r["node"]: r["root"] for r in graph.components(df.select("id"), links, "id").collect()}
    want = roots(len(pts), lambda i, j: (pts[i][0] - pts[j][0]) ** 2 + (pts[i][1] - pts[j][1]) ** 2 <= 0.1 * 0.1)
    assert [got[i] for i in range(len(pts))] == want and got[5000] == 5000


def test_links_of_one_cell_are_in_proportion_to_its_points(spark):
    df = spark.range(3000).selectExpr("id", "id / 1e7 AS x", "0.0 AS y")
    assert graph.proximity_links(df, [], "id", "x", "y", 0.1).count() == 2999


@pytest.mark.parametrize("few", [20, 50_000])
def test_exact_ranks(spark, monkeypatch, few):
    monkeypatch.setattr(ranks, "FEW", few)
    rng = random.Random(7)
    groups = {"ties": [float(rng.randrange(3)) for _ in range(900)], "one value": [4.0] * 400, "tails": [rng.choice((-1, 1)) * 10 ** rng.uniform(-300, 300) for _ in range(700)], "single": [1.5], None: [float(i) for i in range(999, -1, -1)]}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("ties", None), ("ties", float("nan")), ("nothing", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: tuple(r)[1:] for r in neighbours.nearest_rank(df, ["k"], "v").collect()}
    assert got == {k: (*(sorted(vs)[max(1, math.ceil(p * len(vs))) - 1] for p in (0.5, 0.95, 0.99)), max(vs)) for k, vs in groups.items()}
    middle = {r["k"]: r["median"] for r in ranks.median(df, ["k"], "v").collect()}
    assert middle == {k: (sorted(vs)[(len(vs) - 1) // 2] + sorted(vs)[len(vs) // 2]) / 2 for k, vs in groups.items()}
    every = sorted(v for vs in groups.values() for v in vs)
    assert ranks.at_ranks(df, [], "v", {"a": lambda n: F.lit(17), "b": lambda n: n + 1}).first() == (every[16], None)


def test_ranks_of_large_groups_shuffle_no_rows(spark, monkeypatch):
    """Rows of a large group stay where they are: only sketches, counts and the rows of narrow brackets are shuffled; ties may hold a rank."""
    monkeypatch.setattr(ranks, "FEW", 500)
    rng = random.Random(5)
    values = {"ties": [rng.choice([1.0, 2.0, 2.0, 2.0, 7.0]) for _ in range(3000)], "tail": [rng.paretovariate(0.3) for _ in range(3000)], "edge": [0.0] * 2990 + [-1.0] * 5 + [1.0] * 5, None: [rng.gauss(0, 1) for _ in range(2000)], "few": [3.0, 1.0]}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k string, v double").repartition(3).checkpoint()
    wanted = {f"r{i}": (lambda n, i=i: F.greatest(F.lit(1), F.floor(n * i / 10)).cast("bigint")) for i in range(11)} | {"none": lambda n: n + 1}
    seen = []
    checkpoint = type(df).checkpoint
    monkeypatch.setattr(type(df), "checkpoint", lambda self, *a: seen.append(self._jdf.queryExecution().optimizedPlan().toString()) or checkpoint(self, *a))
    got = {r["k"]: list(r)[1:] for r in ranks.at_ranks(df, ["k"], "v", wanted).collect()}
    assert got == {k: [*[sorted(vs)[max(1, len(vs) * i // 10) - 1] for i in range(11)], None] for k, vs in values.items()}
    anti = [line for plan in seen for line in plan.splitlines() if "Join LeftAnti" in line]
    assert anti and all("broadcast" in line for line in anti)


@pytest.mark.parametrize("side", [40.0, 6.0])
def test_clusters_send_no_table_to_the_driver(spark, monkeypatch, side):
    """Neither sparse nor dense clouds: cells and labels are joined by shuffles, however few they are."""
    rng = random.Random(4)
    rows = [(i, rng.uniform(0, side), rng.uniform(0, side)) for i in range(300)]
    points = spark.createDataFrame(rows, "id long, x double, y double").withColumn("k", F.lit(1))
    plans, kind = [], type(points)
    real = kind.checkpoint

    def seen(df, *args):
        plans.append(df)
        return real(df, *args)

    monkeypatch.setattr(kind, "checkpoint", seen)
    links = graph.proximity_links(points, ["k"], "id", "x", "y", 1.0)
    graph.components(points.select("id"), links, "id")
    shown = [df._jdf.queryExecution().executedPlan().toString() for df in [*plans, links]]
    assert sum("SortMergeJoin" in p for p in shown) > 3 and not any("BroadcastHashJoin" in p for p in shown)


@pytest.mark.parametrize(("few", "links"), [(0, 0), (0, 100_000), (32, 0), (32, 100_000)])
def test_roots_of_points_by_way_of_cells(spark, monkeypatch, few, links):
    """By one task and by rounds, with and without the nearest points of large cells; a point without coordinates or key is alone."""
    monkeypatch.setattr(graph, "FEW", few)
    monkeypatch.setattr(graph, "FEW_LINKS", links)
    rng = random.Random(9)
    pts = [(rng.random(), rng.random()) for _ in range(120)] + [(5 + 0.07 * rng.random(), 0.07 * rng.random()) for _ in range(120)]
    turn = [(9 + 0.1 * math.cos(0.03 * i), 0.1 * math.sin(0.03 * i)) for i in range(105)]  # large cells whose outmost points do not tell
    pts += turn + [(x + 0.2 + 1e-3, y) for x, y in turn] + [(0.1 * i, -3.0) for i in range(12)] + [(0.1 * i + 0.01, -4.0 - 0.1 * (i % 2)) for i in range(12)]
    rows = [(k, i, x, y) for k in ("a", "b") for i, (x, y) in enumerate(pts) if k == "a" or i % 3]
    odd = [("a", 5000, None, 1.0), ("b", 5000, 1.0, None), (None, 1, 0.5, 0.5), (None, 2, 0.5, 0.5)]
    got = {(r["k"], r["id"]): r["root"] for r in graph.proximity_roots(spark.createDataFrame(rows + odd, "k string, id long, x double, y double"), ["k"], "id", "x", "y", 0.1).collect()}
    want = {(k, i): i for k, i, _, _ in odd}
    for key in ("a", "b"):
        own = [r for r in rows if r[0] == key]
        found = roots(len(own), lambda i, j: (own[i][2] - own[j][2]) ** 2 + (own[i][3] - own[j][3]) ** 2 <= 0.1 * 0.1)
        want |= {(key, own[i][1]): own[r][1] for i, r in enumerate(found)}
    assert got == want


def test_clusters_of_the_suppliers_take_few_plans(spark, monkeypatch, tmp_path):
    """Dense balances: the driver plans a handful of steps, not rounds of the links and levels of a tree of points."""
    from tidemark import bindings

    rng = random.Random(10)
    rows = [(i, i % 3, round(rng.uniform(0, 300 + 40 * (i % 3)) ** 2 / 30, 2)) for i in range(1500)]
    spark.createDataFrame(rows, "s_suppkey long, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    plans, real = [], type(spark.range(1)).checkpoint
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", lambda df, *a: plans.append(df) or real(df, *a))
    got = {r["s_suppkey"]: r["cluster"] for r in bindings.clusters(spark, str(tmp_path)).collect()}
    assert 0 < len(plans) < 8
    for nation in range(3):
        own = [r for r in rows if r[1] == nation]
        found = roots(len(own), lambda i, j: abs(own[i][2] - own[j][2]) <= 300)
        assert {r[0]: got[r[0]] for r in own} == {r[0]: own[k][0] for r, k in zip(own, found, strict=True)}
