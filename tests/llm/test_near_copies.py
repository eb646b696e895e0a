"""Near copies at a shingle similarity of 0.8 against brute force, and the row that stays."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import near_copies as nc
from tidemark.llm import simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i}" for i in range(3000)]


def jaccard(a, b, k=5):
    a, b = ({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} for w in (a, b))
    return len(a & b) / len(a | b)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return words


def kept(spark, rows):
    return corpus_pipeline.one_of_each_group(spark, spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS), "").collect()


def test_edited_copies_go_and_others_stay(spark):
    rng = random.Random(1)
    rows, near, far = [], [], []
    for i in range(600):
        words = [rng.choice(WORDS) for _ in range(rng.randint(30, 300))]
        copy = edited(rng, words, rng.randint(1, 1 + len(words) // 20))
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(copy).upper())]
        (near if jaccard(words, copy) >= 0.8 else far).append(2 * i + 1)
    stay = {r["doc_id"] for r in kept(spark, rows)}
    assert len(near) > 150 and len(far) > 50
    assert {2 * i for i in range(600)} <= stay and set(far) <= stay
    recall = sum(i not in stay for i in near) / len(near)
    print("recall", recall, "of", len(near))
    assert recall >= 0.99


def test_short_and_empty_texts(spark):
    rows = [(1, "one two"), (2, "ONE  two"), (3, "two one"), (4, None), (5, " \n"), (6, "a b c d e"), (7, "a b c d f")]
    assert sorted(r["doc_id"] for r in kept(spark, rows)) == [1, 3, 4, 6, 7]


def test_rows_without_id_or_with_repeated_ids(spark):
    rng = random.Random(2)
    a, b, c, e = ([rng.choice(WORDS) for _ in range(120)] for _ in range(4))
    near = lambda w: " ".join([*w[:-1], "other"])
    rows = [(None, " ".join(a)), (None, " ".join(b)), (None, near(b)), (None, near(c)), (1, " ".join(c)), (5, " ".join(e)), (5, " ".join(e)), (5, "a text of its own")]
    for f in (lambda df: corpus_pipeline.one_of_each_group(spark, df, ""), simhash.keep_one):
        got = [(r["doc_id"], r["text"]) for r in f(spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS)).collect()]
        assert len(got) == 5 and set(got) >= {(None, " ".join(a)), (1, " ".join(c)), (5, " ".join(e)), (5, "a text of its own")}
        assert sum(t in (" ".join(b), near(b)) for _, t in got) == 1


def family(rng, copies, changed, words=400):
    """A text and copies of it, each with its own words at ``changed`` random places."""
    first = [f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(words)]
    out = [first]
    for i in range(copies):
        own = list(first)
        for at in rng.sample(range(words), changed):
            own[at] = f"x{i}_{at}"
        out.append(own)
    return out


def roots(spark, texts):
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: r["root"] for r in nc.near_groups(docs).collect()}


def brute(texts):
    """Components over all pairs that are similar enough."""
    sets = [{tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))} for t in texts]
    root = list(range(len(texts)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


def same(found, expected):
    return len({(found[i], e) for i, e in enumerate(expected)}) == len(set(found.values())) == len(set(expected))


@pytest.mark.parametrize("tile", [2048, 16])
def test_star_families_stay_together(spark, monkeypatch, tile):
    """Copies of one text, each near it but not near each other, at random places: one group per family, in tiles too."""
    monkeypatch.setattr(nc, "TILE_ROWS", tile)
    texts = [t for seed in range(3) for changed in (5, 6, 7) for t in family(random.Random(10 * seed + changed), 120, changed)]
    found = roots(spark, texts)
    assert same(found, brute(texts)), len(set(found.values()))


def test_chains_and_very_long_texts(spark, monkeypatch):
    rng = random.Random(8)
    chain = [[f"c{i}" for i in range(300)]]
    for i in range(40):
        chain.append([w if k not in (7 * i, 7 * i + 3) else f"y{i}" for k, w in enumerate(chain[-1])])
    long_ = [f"l{rng.randrange(10**6)}" for _ in range(300_000)]
    texts = [*chain, long_, [*long_[:-2], "other"], [f"m{i}" for i in range(50)]]
    monkeypatch.setattr(nc, "TILE_BYTES", 20_000)
    assert same(roots(spark, texts), brute(texts))


def test_packed_hashes_come_back():
    x = np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64)
    assert np.array_equal(nc.unpacked(nc.packed(x).tobytes()), x & np.uint64((1 << 48) - 1)) and len(nc.unpacked(b"")) == 0


def test_blocks_of_fingerprints_propose_pairs(spark, monkeypatch):
    """Whatever the minima miss, near copies within 3 bits meet in the pigeonhole blocks; other texts with such fingerprints stay."""
    rng = random.Random(8)
    monkeypatch.setattr(nc, "_propose", lambda batches: (b.select(["node", "fp"]).slice(0, 0).rename_columns(["u", "v"]) for b in batches))
    monkeypatch.setattr(nc, "_minima", lambda grams: np.random.default_rng(int(grams[0] % np.uint64(1 << 32)) + len(grams)).integers(0, 1 << 63, nc.KEYS * nc.MINIMA, dtype=np.uint64))
    rows, near = [], []
    for i in range(60):
        words = [rng.choice(WORDS) for _ in range(800)]
        for copy, text in enumerate((words, [*words[:-1], "other"], edited(rng, words, 4))):
            rows.append((10 * i + copy, " ".join(text)))
            bits = [nc._fingerprint(g) for _, g in nc.shingle_sets(nc.pa.array([" ".join(words), " ".join(text)]))]
            if copy and (bits[0] ^ bits[1]).bit_count() <= simhash.BITS:
                near.append(10 * i + copy)
    assert len(near) > 60
    stay = {r["doc_id"] for r in kept(spark, rows)}
    assert not stay & set(near) and {10 * i for i in range(60)} <= stay
    links = nc.proposed_by_blocks(spark.createDataFrame([(1, 0), (2, 0), (3, 7), (4, 1 << 40 | 7), (5, 255), (6, -1)], "node long, fp long"))
    assert {(r["u"], r["v"]) for r in links.collect()} == {(1, 2), (1, 3), (3, 4)}
