"""Samples, clusters, neighbours, lattices and modes against plain Python."""

from __future__ import annotations

import math
import os
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import features, graph, lattice, modal, neighbours, sample


def test_sample_weights_sum_to_the_volume(spark):
    rng = random.Random(4)
    rows = [(i, rng.random(), rng.random() if i % 10 else 0.0) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, volume double, g double")
    w = F.col("volume") * F.col("g")
    t = sample.totals(df, w, F.col("volume")).first()
    s = sample.with_volume_weight(sample.importance_sample(df, 300, w, ["id"]), t["total_weight"], t["total_volume"]).collect()
    assert len(s) == 300 and t["zero_weight"] == 200 and all(r["g"] > 0 for r in s)
    assert sum(r["vol_weight"] for r in s) == pytest.approx(t["total_volume"])
    again = sample.importance_sample(df.repartition(7), 300, w, ["id"]).select("id").collect()
    assert {r["id"] for r in again} == {r["id"] for r in s}


def test_concentration_matches_sorting(spark):
    rng = random.Random(5)
    rows = [(rng.randint(1, 20) * 1.0, rng.random()) for _ in range(997)]
    got = {r["mark"]: r["weight_share"] for r in sample.concentration(spark.createDataFrame(rows, "w double, v double"), F.col("w"), F.col("v")).collect()}
    order = sorted((w for w, _ in rows), reverse=True)
    for mark, share in got.items():
        assert share == pytest.approx(sum(order[: max(1, math.ceil(mark * len(order) - 1e-9))]) / sum(order))


def test_clusters_match_union_find(spark):
    rng = random.Random(6)
    pts = [(i, rng.random() * 10, rng.random() * 10) for i in range(300)]
    df = spark.createDataFrame(pts, "id long, x double, y double")
    got = {r["node"]: r["root"] for r in graph.components(df.select("id"), graph.proximity_links(df, [], "id", "x", "y", 0.5), "id").collect()}
    root = list(range(300))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x, y in pts:
        for j, u, v in pts:
            if (x - u) ** 2 + (y - v) ** 2 <= 0.25:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert got == {i: find(i) for i in range(300)}


def test_station_bins_are_closed_at_both_ends(spark):
    got = features.station_bin(spark.createDataFrame([(0.25,), (0.1,), (0.9,)], "x double"), [0.1, 0.2, 0.3], 0.1).collect()
    assert sorted((r["x"], r["station"]) for r in got) == [(0.1, 0.1), (0.25, 0.2), (0.25, 0.3)]


def test_tracking_is_greedy_and_tolerates_gaps(spark):
    rows = [("c", x, 0.1 + 0.1 * x, 0.0, 1, 2.0) for x in (0.1, 0.15, 0.25)] + [("c", x, -0.1, 0.0, -1, -1.0) for x in (0.1, 0.5)]
    df = spark.createDataFrame(rows, "case string, x double, y double, z double, sense int, circulation double")
    got = features.track_links(df, ["case"]).collect()
    assert len({r["track"] for r in got if r["sense"] == 1}) == 1 and len({r["track"] for r in got if r["sense"] == -1}) == 2


def plain_tracks(rows: list[tuple]) -> dict[tuple, int]:
    """All clusters of one case in order, each against all tracks so far."""
    heads, out = [], {}
    for x, y, z, sense, c in sorted(rows, key=lambda r: (r[0], -abs(r[4]), r[1], r[2])):
        fits = [(math.hypot(y - h[1], z - h[2]), k) for k, h in enumerate(heads) if h[3] == sense and 0 < x - h[0] <= features.TRACK_GAP and math.hypot(y - h[1], z - h[2]) <= features.TRACK_BASE + features.TRACK_SLOPE * (x - h[0])]
        k = min(fits)[1] if fits else len(heads)
        heads[k : k + 1] = [(x, y, z, sense)]
        out[x, y, z, sense, c] = k
    return out


@pytest.mark.parametrize("spread", [0.2, 3.0])
def test_competing_clusters_are_tracked_as_in_one_group(spark, spread):
    """Several clusters per station compete: with little spread all are one neighbourhood, with much they are many."""
    rng = random.Random(int(spread * 10))
    cases = {c: [(round(0.1 * k, 1), rng.uniform(-spread, spread), rng.uniform(-0.1, 0.1), rng.choice((-1, 1)), round(rng.uniform(0.5, 2), 1)) for k in range(-3, 6) for _ in range(12)] for c in ("a", "b")}
    df = spark.createDataFrame([(c, *r) for c, rows in cases.items() for r in rows], "case string, x double, y double, z double, sense int, circulation double")
    got = {(r["case"], *list(r)[1:6]): r["track"] for r in features.track_links(df.repartition(3), ["case"]).collect()}
    assert got == {(c, *r): k for c, rows in cases.items() for r, k in plain_tracks(rows).items()}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the standard tables are not here")
def test_tracks_of_the_suppliers(spark):
    """The query against plain tracking of each nation, of which suppliers compete."""
    from tidemark import bindings

    rows = bindings.tracks(spark, "/root/testdata/sf0.01").collect()
    of = {k: [tuple(r)[1:6] for r in rows if r["s_nationkey"] == k] for k in {r["s_nationkey"] for r in rows}}
    want = {(k, *r): t for k, some in of.items() for r, t in plain_tracks(some).items()}
    assert {(r["s_nationkey"], *tuple(r)[1:6]): r["track"] for r in rows} == want and len(rows) == len(want)
    assert sum(len(x) for x in of.values()) > 3 * sum(len({t for k, t in ((key[0], t) for key, t in want.items()) if k == n}) for n in of) > 3 * len(of)


def test_tracks_of_nothing(spark):
    df = spark.createDataFrame([], "case string, x double, y double, z double, sense int, circulation double, track_note string")
    assert features.track_links(df, ["case"]).count() == 0


def test_mirror_pairs_on_a_lattice(spark):
    h = 0.5
    rows = [(k, (i + 0.5) * h, (j + 0.5) * h) for k, (i, j) in enumerate((i, j) for i in range(-4, 4) for j in range(3))]
    df = spark.createDataFrame([(k, x, y, h) for k, x, y in rows], "id long, x double, y double, size double")
    out = neighbours.mirror_pairs(df, "id", "x", ["x", "y"], "size")
    assert out.filter("outcome = 'paired' and distance < 1e-9").count() == len(rows)
    c = neighbours.outcome_counts(out, len(rows)).first()
    assert c["on_plane"] + c["paired"] + c["level_mismatch"] + c["unpaired"] == c["cells"]


def test_nearest_matches_brute_force(spark):
    rng = random.Random(8)
    a = [(i, rng.random(), rng.random()) for i in range(100)]
    b = [(i, rng.random(), rng.random()) for i in range(100)]
    got = {r["id"]: r["nearest"] for r in neighbours.nearest_within(spark.createDataFrame(a, "id long, x double, y double"), spark.createDataFrame(b, "pid long, x double, y double"), ["x", "y"], 0.1, "id", "pid").collect()}
    for i, x, y in a:
        d, j = min((math.hypot(x - u, y - v), k) for k, u, v in b)
        assert got[i] == (j if d <= 0.1 else None)


def test_histogram_and_missing_nodes(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (0.99,), (1.0,), (7.0,), (None,)], "v double")
    assert {r["bin"]: r["n"] for r in neighbours.histogram_fixed(df, F.col("v"), [0.0, 0.5, 1.0]).collect()} == {0: 1, 1: 2, 2: 2}
    nodes = spark.createDataFrame([(a, b) for a in range(5) for b in range(4) if not (a in (1, 2) and b == 2)], "a int, b int")
    lost = lattice.lattice_missing(nodes, "a", "b")
    assert sorted((r["a"], r["b"]) for r in lost.collect()) == [(1, 2), (2, 2)]
    assert lattice.unexplained(lost, [F.col("a") - 1.5, F.col("b") - 2.0], [0.5, 0.5]).count() == 0


@pytest.mark.parametrize("stretch", [1, 3, 1 << 15])
def test_missing_nodes_by_stretches(spark, stretch):
    """Keys with other axes, repeated nodes, a null in a (an a of its own), nulls in b and the key (no nodes)."""
    rng = random.Random(stretch)
    rows = [(k, a, b) for k, n in (("p", 20), ("q", 5)) for a in [*range(6), None] for b in range(n) if rng.random() < 0.7 for _ in range(rng.choice((1, 2)))]
    df = spark.createDataFrame([*rows, (None, 1, 77), ("p", 2, None)], "k string, a int, b int")
    got = sorted(map(tuple, lattice.lattice_missing(df, "a", "b", ["k"], stretch).collect()), key=str)
    axes = {k: ({a for q, a, _ in rows if q == k}, {b for q, _, b in rows if q == k}) for k in ("p", "q")}
    assert got == sorted(((k, a, b) for k, (xs, ys) in axes.items() for a in xs for b in ys if (k, a, b) not in set(rows)), key=str)
    assert lattice.lattice_missing(df.limit(0), "a", "b", ["k"], stretch).count() == 0


def test_arithmetic_runs(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([1, 3, 5, 7, 8, 20, 19, 18])], "k string, i long, v long")
    assert sorted((r["length"], r["start"], r["step"]) for r in lattice.arithmetic_runs(df, ["k"], "i", "v").collect()) == [(3, 20, -1), (4, 1, 2)]


def test_discretization_recovers_the_order(spark):
    f = lambda h: 1.0 + 0.3 * h**2
    r = modal.discretization(spark.createDataFrame([("q", f(1.0), f(2.0), f(4.0))], "k string, fine double, medium double, coarse double"), ["k"], "fine", "medium", "coarse", 2.0).first()
    assert r["p"] == pytest.approx(2.0) and r["extrapolated"] == pytest.approx(1.0) and r["status"] == "converged"


def test_pod_rebuilds_the_field(spark):
    rng = np.random.default_rng(3)
    field = np.outer(rng.normal(size=12), np.sin(np.arange(8))) + 0.5 * np.outer(rng.normal(size=12), np.cos(2 * np.arange(8)))
    rows = [(n, t, float(field[n, t])) for n in range(12) for t in range(8)]
    df = spark.createDataFrame(rows, "node int, step int, u double")
    energies, modes, a = modal.pod(df, "node", "step", ["u"])
    mean = df.groupBy("node").agg(F.avg("u").alias("u"))
    back = {(r["node"], r["step"]): r["u"] for r in modal.reconstruct(modes, a, "node", "step", ["u"], mean).collect()}
    assert max(abs(back[n, t] - v) for n, t, v in rows) < 1e-9
    assert sum(energies) == pytest.approx(((field - field.mean(axis=1, keepdims=True)) ** 2).mean(axis=1).mean())


def test_principal_axis_of_a_line(spark):
    df = spark.createDataFrame([("a", float(i), 0.5 * i) for i in range(10)], "k string, x double, y double")
    r = features.principal_axis(df, ["k"], "x", "y").first()
    assert r["axis_angle"] == pytest.approx(math.degrees(math.atan(0.5))) and r["planarity"] == pytest.approx(1.0)


def test_pod_energies_match_numpy_with_gaps(spark):
    """Two values per node, nodes without some steps: energies are those of the matrix of fluctuations."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 2, 6))
    there = rng.random((40, 6)) < 0.8
    rows = [(n, k, float(x[n, 0, k]), float(x[n, 1, k])) for n in range(40) for k in range(6) if there[n, k]]
    energies, _, _ = modal.pod(spark.createDataFrame(rows, "node long, step long, u double, v double").repartition(5), "node", "step", ["u", "v"], share=1.0)
    m = np.where(there[:, None, :], x, np.nan)
    m = np.nan_to_num(m - np.nanmean(m, axis=2, keepdims=True)).reshape(-1, 6)
    want = np.sort(np.linalg.eigvalsh(m.T @ m / 40 / 6))[::-1]
    assert np.allclose(energies, want[: len(energies)], atol=1e-9)


@pytest.mark.parametrize(("steps", "rank"), [(40, 6), (30, 30)])
def test_modes_by_the_range_finder_are_those_of_the_gram_matrix(spark, steps, rank):
    """Two values per node, nodes without some steps; once with few modes, once with as many as steps."""
    rng = np.random.default_rng(rank)
    x = np.einsum("nr,rt->nt", rng.normal(size=(120, rank)), rng.normal(size=(rank, steps)) * (0.6 ** np.arange(rank))[:, None]).reshape(60, 2, steps)
    rows = [(n, t, float(x[n, 0, t]), float(x[n, 1, t])) for n in range(60) for t in range(steps) if (n * 7 + t) % 11]
    df = spark.createDataFrame(rows, "node long, step long, u double, v double").repartition(5)
    share = 0.99 if rank < steps else 1.0
    want, modes, a = modal.pod(df, "node", "step", ["u", "v"], share=share)
    got, other, b = modal.pod_of_many(df, "node", "step", ["u", "v"], share=share, search=4, passes=8)
    assert len(got) == len(want) and got == pytest.approx(want, rel=1e-6, abs=1e-12)
    strong = sum(w > 1e-3 * want[0] for w in want)
    for left, right, key, values in ((modes, other, "node", ["u", "v"]), (a, b, "step", ["a"])):
        far = left.filter(F.col("k") <= strong).alias("l").join(right.alias("r"), [key, "k"]).agg(F.count(F.lit(1)), *[F.max(F.abs(F.col(f"l.{v}") - F.col(f"r.{v}"))) for v in values]).first()
        assert far[0] == strong * (60 if key == "node" else steps) and max(far[1:]) < 1e-3


def test_modes_of_five_thousand_steps(spark):
    rng = np.random.default_rng(1)
    t = np.arange(5000)
    left = np.linalg.qr(rng.normal(size=(20, 3)))[0]
    field = left @ (np.array([3.0, 2.0, 1.0])[:, None] * np.stack([np.sin(0.3 * t), np.cos(0.11 * t), np.sin(0.017 * t)]))
    nodes = spark.createDataFrame([(n, field[n].tolist()) for n in range(20)], "node int, u array<double>")
    df = nodes.select("node", F.posexplode("u").alias("step", "u"))
    energies, modes, a = modal.pod(df, "node", "step", ["u"])
    still = field - field.mean(axis=1, keepdims=True)
    want = np.linalg.svd(still, compute_uv=False) ** 2 / 20 / 5000
    assert len(energies) == 4 and energies[:3] == pytest.approx(want[:3], rel=1e-8)
    back = modal.reconstruct(modes, a, "node", "step", ["u"])
    far = back.join(df.withColumnRenamed("u", "w"), ["node", "step"]).join(df.groupBy("node").agg(F.avg("u").alias("m")), "node")
    assert far.agg(F.count(F.lit(1)), F.max(F.abs(F.col("u") + F.col("m") - F.col("w")))).first()[0] == 100_000
    assert far.agg(F.max(F.abs(F.col("u") + F.col("m") - F.col("w")))).first()[0] < 1e-6


def test_tracking_hands_plain_columns_to_pandas(spark, monkeypatch):
    """A struct would be an object per row in a worker."""
    from pyspark.sql import GroupedData

    seen, apply = [], GroupedData.applyInPandas
    monkeypatch.setattr(GroupedData, "applyInPandas", lambda self, f, schema: seen.append(schema) or apply(self, f, schema))
    rows = [(k, x / 10, 0.01 * x, 0.0, 1, 2.0) for k in ("a", "b") for x in range(5)]
    got = features.track_links(spark.createDataFrame(rows, "case string, x double, y double, z double, sense int, circulation double"), ["case"]).collect()
    assert seen and "struct" not in seen[0]
    assert sorted((str(r["case"]), r["track"]) for r in got) == [("a", 0)] * 5 + [("b", 0)] * 5


@pytest.mark.parametrize(("station", "ends"), [(1, 1), (8, 64)])
def test_greedy_tracks_in_strips_are_those_of_all_ends(monkeypatch, station, ends):
    """Ordered strips against every end so far: ties, equal places, one or many stations, many tolerances, dense and sparse."""
    monkeypatch.setattr(features, "STATION", station)
    monkeypatch.setattr(features, "ENDS", ends)
    fixed = (features.TRACK_BASE, features.TRACK_SLOPE, features.TRACK_GAP)
    rng = np.random.default_rng(8)
    for k in range(24):
        n = int(rng.integers(1, 500))
        x = np.sort((rng.integers(0, 6, n) / 10, rng.uniform(0, 1, n), rng.integers(0, 40, n) / 70)[k % 3])
        y, z = rng.uniform(0, (0.02, 0.1, 0.5, 3)[k % 4], (2, n))
        if k % 2:
            y, z = np.round(y, 2), rng.integers(0, 3, n) / 20
        heads, want = [], []
        for i in range(n):
            j = np.array(heads, int)
            gap, d = x[i] - x[j], np.hypot(y[i] - y[j], z[i] - z[j])
            d[(gap <= 0) | (gap > fixed[2]) | (d > fixed[0] + fixed[1] * gap)] = np.inf
            best = int(d.argmin()) if len(d) and d.min() < np.inf else len(heads)
            heads[best : best + 1] = [i]
            want.append(best)
        assert features.greedy_tracks(x, y, z, *fixed).tolist() == want
    odd = np.array([[0.0, 0.1, 0.1, 0.2, math.nan, math.nan], [1.0, math.nan, 1.0, 1.0, 1.0, 1.0], [0.0, 0.0, 0.0, math.inf, 0.0, 0.0]])
    assert features.greedy_tracks(*odd, *fixed).tolist() == [0, 1, 0, 2, 3, 4]


def test_tracking_time_follows_the_clusters_not_their_square():
    """40,000 clusters at 20 stations: with each against all ends so far this took some 20 times as long as a tenth of them."""
    rng = np.random.default_rng(9)
    calls, real = [0], features.np.hypot

    class Counted:
        def __getattr__(self, name):
            return getattr(np, name)

        def hypot(self, a, b):
            calls[0] += np.size(a)
            return real(a, b)

    of = {}
    for each in (200, 2000):
        x, y, z = np.repeat(np.arange(20) / 10, each), rng.normal(0.1, 0.05, 20 * each), rng.integers(0, 3, 20 * each) / 20
        calls[0] = 0
        with pytest.MonkeyPatch.context() as m:
            m.setattr(features, "np", Counted())
            features.greedy_tracks(x, y, z, features.TRACK_BASE, features.TRACK_SLOPE, features.TRACK_GAP)
        of[each] = calls[0]
    assert of[2000] < 15 * of[200]


def test_tracking_computes_its_input_once(spark, tmp_path):
    """What clusters are made of is read once, however many joins and numbers the tracks take."""
    def seen(batches, to=str(tmp_path)):
        tempfile.mkstemp(dir=to)
        yield from batches

    rows = [(k, x / 10, 0.01 * x, 0.0, 1, 2.0) for k in ("a", "b") for x in range(5)]
    df = spark.createDataFrame(rows, "case string, x double, y double, z double, sense int, circulation double").coalesce(1)
    got = features.track_links(df.mapInArrow(seen, df.schema), ["case"]).collect()
    assert sorted((r["case"], r["track"]) for r in got) == [("a", 0)] * 5 + [("b", 0)] * 5
    assert len(list(tmp_path.iterdir())) == 1


def test_equal_clusters_keep_the_order_of_their_tracks(spark):
    """Tracks that begin with equal clusters are numbered as one after the other would number them."""
    rows = [("a", 0.0, 0.0, 0.0, 1, 1.0)] * 9 + [("a", 0.1, 0.001 * k, 0.0, 1, 9.0 - k) for k in range(9)]
    got = features.track_links(spark.createDataFrame(rows, "case string, x double, y double, z double, sense int, circulation double"), ["case"]).collect()
    assert sorted((r["y"], r["track"]) for r in got if r["x"] > 0) == [(0.001 * k, k) for k in range(9)]
