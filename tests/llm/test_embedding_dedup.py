"""Near-duplicate embeddings against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tests.llm.test_oracles_llm import compare_tables
from tidemark.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int, node string, keys int, copies int"


def family(rng, n, size, spread):
    """Vectors about one direction: two of them have a cosine of about 1 / (1 + spread^2)."""
    centre = rng.standard_normal(size)
    centre /= np.linalg.norm(centre)
    return [(centre + spread / math.sqrt(size) * rng.standard_normal(size)).tolist() for _ in range(n)]


def table(seed=1):
    rng = np.random.default_rng(seed)
    vectors = [(v, 1) for spread in (0.03, 0.1, 0.14, 0.2) for v in family(rng, 60, 64, spread)]
    vectors += [(v, 2) for v in family(rng, 150, 24, 0.12)]
    vectors += [(rng.standard_normal(64).tolist(), 1) for _ in range(200)]
    vectors += [(vectors[0][0], 1)] * 5 + [(vectors[0][0], 3), (vectors[0][0], None), (vectors[0][0][:24], 1)]
    vectors += [([2.0 * x for x in vectors[5][0]], 1), ([-x for x in vectors[5][0]], 1)]
    return [(i, v, label, "a", 1, 2) for i, (v, label) in enumerate(vectors)]


def odd_rows(at):
    return [
        (at, None, 1, None, None, None), (at + 1, [0.0, 0.0], 1, None, None, None), (at + 2, [], 1, None, None, None), (at + 3, [1.0, None], 1, None, None, None),
        (at + 4, [1.0, float("nan")], 1, None, None, None), (at + 5, [float("inf"), 1.0], 1, None, None, None), (at + 6, [float("inf"), 1.0], 1, None, None, None),
        (at + 7, [1.0, 0.0], 9, None, None, None), (at + 8, [1.0, -0.0], 9, None, None, None), (at + 9, [3.0], 9, None, None, None), (at + 10, [4.0], 9, None, None, None),
        (at + 11, [1e-38, 0.0], 8, None, None, None), (at + 12, [3e38, 0.0], 8, None, None, None),
    ]


def test_equals_all_pairs(spark):
    rows = table()
    compare_tables(spark, ed.embedding_groups, ed.ORACLE, {"embeddings": (rows + odd_rows(len(rows)), SCHEMA)})


@pytest.mark.parametrize("tile", [8, 40])
def test_large_buckets_are_dealt_to_tiles(spark, monkeypatch, tile):
    monkeypatch.setattr(ed, "TILE", tile)
    compare_tables(spark, ed.embedding_groups, ed.ORACLE, {"embeddings": (table(2), SCHEMA)})


def test_blocks_within_a_bucket(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, v, 1, None, None, None) for i, v in enumerate(family(rng, 1300, 16, 0.08))]
    compare_tables(spark, ed.embedding_groups, ed.ORACLE, {"embeddings": (rows, SCHEMA)})


def test_ids_that_are_null_or_repeated(spark):
    v, w = [1.0, 2.0], [2.0, -1.0]
    rows = [(None, v, 1, None, None, None), (5, v, 1, None, None, None), (5, v, 1, None, None, None), (3, v, 1, None, None, None), (None, w, 1, None, None, None), (None, None, 1, None, None, None)]
    got = sorted((tuple(r) for r in ed.embedding_groups(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    expected = [(3, 3, 3, True), (5, 3, 3, False), (5, 3, 3, False), (None, 3, 3, False), (None, 0, None, True), (None, 0, None, True)]
    assert got == sorted(expected, key=repr)


def test_no_rows(spark):
    assert ed.embedding_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def test_pairs_at_the_threshold_share_a_key():
    """Of pairs at a cosine of 0.98 to 0.981, the farthest that link, all but one in ten thousand share a key, and a sketch."""
    rng = np.random.default_rng(6)
    a = rng.standard_normal((20_000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal(a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    cos = rng.uniform(0.98, 0.981, (len(a), 1))
    near = cos * a + np.sqrt(1 - cos * cos) * b
    label = np.ones(len(a), np.int64)
    (ka, sa), (kb, sb) = ed.keys_of(a, label), ed.keys_of(near, label)
    missed = 1 - (((ka == kb).any(axis=1)) & (np.bitwise_count((sa ^ sb).view(np.uint64)) <= ed.SKETCH_BITS)).mean()
    print("missed", missed)
    assert missed <= 1e-3
    assert (ka[:-1] == ka[1:]).any(axis=1).mean() < 0.01  # unrelated vectors rarely meet
