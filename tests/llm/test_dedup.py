"""Exact dedup, SimHash groups and components against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import xxhash

from tidemark.llm import components, exact_dedup, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, group_size string, digest string"  # two columns that clash with names used inside


def odd_rows():
    return [(1, None, "x", "y"), (2, "", "x", "y"), (3, "Ab É", "x", "y"), (4, "aB É", "x", "y"), (5, "ab é", None, None), (5, "ab é", None, None), (None, "ab é", None, None), (None, None, None, None), (9, "w " * 30_000, "x", "y"), (8, "W " * 30_000, "x", "y")]


def expected(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def check(spark, rows, **options):
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, SCHEMA), **options).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=repr) == expected(rows)
    kept = defaultdict(int)
    for r in got:
        kept[r["text_sha256"]] += r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert set(kept.values()) <= {1}


def test_exact_dedup_of_odd_rows(spark):
    check(spark, odd_rows())


def test_exact_dedup_with_heavy_groups(spark):
    rng = random.Random(1)
    rows = odd_rows() + [(100 + i, rng.choice(["Hot", "hoT", f"t{rng.randint(0, 400)}"]), "x", "y") for i in range(2000)] + [(50, "hot", "x", "y")] * 3
    check(spark, rows, heavy=4, tracked=64)


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.exact_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components_match_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(0, i) for i in range(301, 500)] + [(i, i + 1) for i in range(600, 640)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = list(range(1000))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {i: find(i) for e in edges for i in e if find(i) != i}


def brute_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_groups(rows):
    prints = [brute_fingerprint(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, f"{p:016x}", least.get(find(i))) for i, ((d, *_), p) in enumerate(zip(rows, prints, strict=True))), key=repr)


def test_simhash_groups_match_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    base = [[rng.choice(words) for _ in range(rng.randint(3, 200))] for _ in range(60)]
    rows = odd_rows()
    for i in range(300):
        doc = list(rng.choice(base))
        if rng.random() < 0.6:
            doc[rng.randrange(len(doc))] = rng.choice(words)
        rows.append((100 + i, rng.choice([" ", "\t", "  "]).join(doc), "x", "y"))
    rows += [(900, "\x85one two", "x", "y"), (901, " \n", "x", "y")]
    got = simhash.simhash_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=repr) == brute_groups(rows)
    kept = simhash.keep_one(spark.createDataFrame([r for r in rows if r[0] is not None], SCHEMA))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in brute_groups([r for r in rows if r[0] is not None])})
    assert kept.columns == ["doc_id", "text", "group_size", "digest"]


def test_every_close_pair_shares_a_key():
    rng = random.Random(4)
    masks = simhash.block_masks()
    for _ in range(2000):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 3)))
        assert any(a & m == b & m for m in masks)


def test_both_ways_of_searching_a_key_agree():
    rng = np.random.default_rng(5)
    mask = simhash.block_masks()[0]
    free = [k for k in range(64) if not mask >> k & 1]
    centres = [int(rng.integers(0, 1 << 62)) & mask for _ in range(1)]
    fps = {c ^ sum(1 << int(k) for k in rng.choice(free, rng.integers(0, 7), replace=False)) for c in centres for _ in range(400)}
    fps = np.array(sorted(fps), np.uint64)

    def parts(edges):
        root = list(range(len(fps)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in zip(*edges, strict=True):
            a, b = find(int(a)), find(int(b))
            root[max(a, b)] = min(a, b)
        return [find(i) for i in range(len(fps))]

    assert parts(simhash.forest_by_comparison(fps, 3)) == parts(simhash._forest_by_flips(fps, mask, 3))


def test_simhash_of_nothing(spark):
    assert simhash.simhash_groups(spark.createDataFrame([], SCHEMA)).collect() == []
