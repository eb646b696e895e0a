"""The attention model and the scores that are fixed by counts."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import attention as A
from tidemark.llm import language_model as lm
from tidemark.llm.token_files import default_tokenizer

SCHEMA = "doc_id long, text string, score string, row string"


def batch_of(v, rng, n=3):
    ids = rng.integers(0, len(v.rank), (n, A.WINDOW + 2))
    return v.row[ids[:, 1:-1]], v.row[ids[:, :-2]], v.rank[ids[:, 2:]], rng.random((n, A.WINDOW)) < 0.8


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(A, "ROWS", 90)
    return A.Vocabulary(np.random.default_rng(0).integers(0, 1000, 200).astype(float))


def test_gradients_by_differences(small):
    rng = np.random.default_rng(0)
    flat = A.start_weights(small).astype(np.float64)
    shapes = small.shapes()
    w, g = A.unflatten(flat, shapes), A.unflatten(np.zeros_like(flat), shapes)
    data = batch_of(small, rng)
    _, sparse = A.gradients(w, small, *data, g)
    for name, (rows, sums) in sparse.items():
        g[name][rows] = sums
    for name, shape in shapes.items():
        for _ in range(4):
            at = tuple(int(rng.integers(0, s)) for s in shape)
            want, loss = g[name][at], []
            for e in (1e-5, -2e-5):
                w[name][at] += e
                loss.append(A.gradients(w, small, *data, A.unflatten(np.zeros_like(flat), shapes))[0])
            w[name][at] += 1e-5
            assert want == pytest.approx((loss[0] - loss[1]) / 2e-5, rel=1e-3, abs=1e-7), (name, at)


def test_next_subwords_sum_to_one_and_see_only_the_past(small):
    rng = np.random.default_rng(1)
    s = A.Scorer(A.start_weights(small), small)
    assert small.rest is not None and small.learned
    now, before = small.row[rng.integers(0, 200, (2, 1, A.WINDOW))]
    y = A._attended(s.w, now, before)[-1]
    for place in (0, 9, A.WINDOW - 1):
        logs = A.log_probability(s.layers, small, np.repeat(y[place : place + 1], 200, axis=0), np.arange(200, dtype=np.int32))
        assert np.exp(logs.astype(float)).sum() == pytest.approx(1, rel=1e-4)
    later = now.copy()
    later[0, 9:] = 3
    again = A._attended(s.w, later, before)[-1]
    assert np.array_equal(y[:9], again[:9]) and not np.array_equal(y[9:], again[9:])


def test_all_short_sequences_sum_to_one(monkeypatch):
    """Over all texts of at most three subwords, and those that are longer, the probability is one."""
    monkeypatch.setattr(A, "ROWS", 4)
    v = A.Vocabulary(np.array([5.0, 3, 1, 1, 0, 2]))  # the last id is the end
    s = A.Scorer(A.start_weights(v), v)
    ended = going_on = 0.0
    for k in range(4):
        for ids in itertools.product(range(5), repeat=k):
            logs = s.log10(np.array(ids, np.int64), np.array([k]), 5)
            ended += 10 ** logs.sum()
            going_on += 10 ** logs[:-1].sum() * (1 - 10 ** logs[-1]) if k == 3 else 0.0
    assert ended + going_on == pytest.approx(1, rel=1e-4)


def test_weights_that_could_overflow_are_told_and_stay_exact(small):
    flat = A.start_weights(small)
    assert A.Scorer(flat, small).safe
    w = A.unflatten(flat, small.shapes())
    w["out"] *= 1000
    s = A.Scorer(flat, small)
    calm = A.Scorer(A.start_weights(small), small)
    exact = calm.log10(np.arange(100), np.array([100]), 199)
    calm.safe = False  # the careful way gives the same
    assert calm.log10(np.arange(100), np.array([100]), 199) == pytest.approx(exact, rel=1e-5)
    assert not s.safe and np.isfinite(s.log10(np.arange(100), np.array([100]), 199)).all()


def test_each_subword_is_scored_once_with_half_a_window_before_it():
    for n in (1, 5, A.WINDOW, A.WINDOW + 1, 1000):
        start, _ = A.windows_of(np.array([n]))
        seen = Counter()
        for s in start.tolist():
            for k in range(A.WINDOW):
                if s + k < n and (s == 0 or k >= A.WINDOW - A.STRIDE):
                    seen[s + k] += 1
                    assert s == 0 or k >= 32
        assert seen == Counter(range(n))


def test_scores_of_a_long_text_agree_with_one_window_at_a_time(small):
    rng = np.random.default_rng(4)
    s = A.Scorer(A.start_weights(small), small)
    ids = rng.integers(0, 199, 150)
    got = s.log10(ids, np.array([150]), 199)
    seq = np.concatenate([[199, 199], ids, [199]])
    for place in (0, 1, 40, 63, 64, 95, 96, 149, 150):
        lo = 0 if place < A.WINDOW else A.STRIDE * (1 + (place - A.WINDOW) // A.STRIDE)
        now, before = np.zeros((2, 1, A.WINDOW), np.uint16)
        n = place - lo + 1
        now[0, :n], before[0, :n] = small.row[seq[lo + 1 : place + 2]], small.row[seq[lo : place + 1]]
        y = A._attended(s.w, now, before)[-1][n - 1 : n]
        assert got[place] == pytest.approx(A.log_probability(s.layers, small, y, small.rank[seq[place + 2 : place + 3]])[0] / math.log(10), rel=1e-4)


@pytest.mark.parametrize("safe", [True, False])
def test_blocks_score_what_windows_score_and_take_each_place_once(small, monkeypatch, safe):
    rng = np.random.default_rng(7)
    sizes = np.array([0, 31, 0, 32, 63, 64, 200, 1, 95, 96])
    ids = rng.integers(0, 199, sizes.sum())
    s = A.Scorer(A.start_weights(small), small)
    s.safe, seen, real = safe, [], A.Scorer._states
    monkeypatch.setattr(A.Scorer, "_states", lambda self, now, before, opens: (seen.append((len(now), len(opens))), real(self, now, before, opens))[1])
    got = {batch: s.log10(ids, sizes, 199, batch) for batch in (1, 3, 128)}
    blocks = int((-(-(sizes + 1) // A.STRIDE)).sum())
    assert seen[-1] == ((blocks + 1) * A.STRIDE, blocks)
    start, text = A.windows_of(sizes + 1)
    stop = np.cumsum(sizes + 1)
    first, want = stop - sizes - 1, np.full(stop[-1], np.nan)
    for at, t in zip(start.tolist(), text.tolist(), strict=True):
        here = ids[first[t] - t : stop[t] - t - 1]  # t ends come before
        seq = np.concatenate([[199, 199], here, [199]])
        lo, n = at - first[t], min(A.WINDOW, stop[t] - at)
        now, before = np.zeros((2, 1, A.WINDOW), np.uint16)
        now[0, :n], before[0, :n] = small.row[seq[lo + 1 : lo + n + 1]], small.row[seq[lo : lo + n]]
        skip = 0 if lo == 0 else A.WINDOW - A.STRIDE
        y = A._attended(s.w, now, before)[-1][skip:n]
        want[at + skip : at + n] = A.log_probability(s.layers, small, y, small.rank[seq[lo + skip + 2 : lo + n + 2]]) / math.log(10)
    for logs in got.values():
        np.testing.assert_allclose(logs, want, rtol=1e-4)


def test_layers_are_the_weights_themselves(small):
    """A step copies neither the output's weights nor their gradients."""
    flat = A.start_weights(small)
    layers = A._layers(A.unflatten(flat, small.shapes()), small)
    assert len(layers) > 1 and all(np.shares_memory(x, flat) for x in layers)
    assert [x.shape[1] for x in layers] == [b - a for a, b in small.columns()] and sum(x.shape[1] for x in layers) == len(small.bias)
    assert np.array_equal(np.concatenate([x[-1] for x in layers]), small.bias)


@pytest.mark.parametrize("rows", [1, 511, 512, 513, 900])
def test_products_by_parts(rows):
    rng = np.random.default_rng(8)
    a, b, c = rng.random((rows, 33)), rng.random((33, 20)), rng.random((rows, 20))
    np.testing.assert_allclose(A._by_parts(a, b), a @ b, rtol=1e-12)
    np.testing.assert_allclose(A._by_parts(c, b.T), c @ b.T, rtol=1e-12)
    np.testing.assert_allclose(A._summed_by_parts(a, c), a.T @ c, rtol=1e-12)


def test_places_without_a_target_go_where_a_step_is_cheapest(small, monkeypatch):
    """They weigh nothing, and cost no output of a group."""
    seen, real = [], A.gradients
    monkeypatch.setattr(A, "gradients", lambda w, v, now, before, target, live, g: (seen.append((target, live)), real(w, v, now, before, target, live, g))[1])
    windows = np.random.default_rng(2).integers(0, 200, (4, A.WINDOW + 2))
    windows[:, 40:] = -1
    assert small.rank[0] >= small.head
    flat = A.train_locally(A.start_weights(small), small, windows, 0.01, 4)
    ((target, live),) = seen
    assert not live[:, 38:].any() and (target[~live] == 0).all() and np.isfinite(flat).all()


@pytest.mark.parametrize("block", [16, 24, A.WINDOW])
def test_blocks_of_places_change_neither_states_nor_gradients(small, monkeypatch, block):
    data = batch_of(small, np.random.default_rng(3))
    flat = A.start_weights(small).astype(np.float64)
    w = A.unflatten(flat, small.shapes())

    def all_of():
        g = A.unflatten(np.zeros_like(flat), small.shapes())
        loss, sparse = A.gradients(w, small, *data, g)
        states = [A._attended(w, *data[:2], skip, safe)[-1] for skip in (0, A.WINDOW - A.STRIDE) for safe in (True, False)]
        return [np.array(loss), *g.values(), *(x for pair in sparse.values() for x in pair), *states]

    want = all_of()
    monkeypatch.setattr(A, "BLOCK", block)
    for a, b in zip(want, all_of(), strict=True):
        np.testing.assert_allclose(a, b, rtol=1e-5, atol=1e-8)


def test_freed_memory_is_kept_by_the_process():
    """Arrays of a step use the same pages again: no page faults once they were touched."""
    import subprocess
    import sys

    program = """
import resource, numpy as np
from tidemark.llm import attention as A
A.keep_pages()
def step():
    held = [np.ones(1 << 18, np.float32) for _ in range(20)]
for _ in range(3): step()
before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
for _ in range(10): step()
print(resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before)
"""
    assert int(subprocess.run([sys.executable, "-c", program], capture_output=True, text=True, check=True).stdout) < 1000


def test_segments_hold_every_target_once():
    rng = np.random.default_rng(5)
    sizes = np.array([0, 3, 5000, 2047, 2048, 64])
    ids = rng.integers(0, 50_000, sizes.sum())
    rows = lm.segments_of(ids, sizes, np.arange(6) - 2, 50_256).to_pylist()
    at = np.concatenate([[0], np.cumsum(sizes)])
    for doc in range(6):
        mine = sorted((r for r in rows if r["doc_id"] == doc - 2), key=lambda r: r["segment"])
        w = lm.windows_in([r["ids"] for r in mine], 50_256)
        assert [len(lm.windows_in([r["ids"]], 50_256)) for r in mine] == [r["n"] for r in mine]
        targets = w[:, 2:][w[:, 2:] >= 0]
        assert targets.tolist() == [*ids[at[doc] : at[doc + 1]].tolist(), 50_256]
        assert w[0, :2].tolist() == [50_256, 50_256] and (w[1:, :2] == w[:-1, -2:]).all()


def test_training_lowers_the_loss():
    v = A.Vocabulary(np.ones(200))
    flat = A.start_weights(v)
    w = (np.cumsum(np.ones((600, A.WINDOW + 2), int), axis=1) * 7 + np.random.default_rng(2).integers(0, 200, (600, 1))) % 200
    loss = lambda f: -A.Scorer(f, v).log10(w[:20, 2:].ravel(), np.full(20, A.WINDOW), 199).mean()
    before = loss(flat)
    for _ in range(3):
        flat = A.train_locally(flat, v, w, 0.02, 8)
    assert loss(flat) < 0.5 * before


def corpus():
    rng = np.random.default_rng(3)
    words = [f"{a}{b}" for a in ("sea", "wind", "stone", "The", "runs") for b in ("", "s", "ing,", "er")]
    rows = [(int(i), " ".join(rng.choice(words, rng.integers(0, 60))) + (f" rare{i}" if i % 7 == 0 else ""), "x", "y") for i in range(200)]
    return rows + [(None, "no id here", "x", "y"), (500, None, "x", "y"), (501, "", "x", "y"), (502, "long " * 30_000, "x", "y"), (7, rows[7][1], "x", "y")]


def base(rows):
    words_of = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if w] + [None]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    counts = Counter(w for d, t, *_ in rows if not held(d) for w in words_of(t))
    n, v = sum(counts.values()), len(counts)
    for d, t, *_ in rows:
        w = words_of(t)
        yield d, held(d), len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)


@pytest.mark.parametrize("head", [200_000, 4])
def test_base_scores_match_brute_force(spark, head):
    rows = corpus()
    got = sorted(lm.score(spark.createDataFrame(rows, SCHEMA), head=head).collect(), key=lambda r: (repr(r["doc_id"]), r["n_tokens"]))
    want = sorted(base(rows), key=lambda r: (repr(r[0]), r[2]))
    for r, (d, held, n, known, total, score) in zip(got, want, strict=True):
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (d, held, n, known, total)
        assert r["base_score"] == pytest.approx(score, rel=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0


def test_head_and_tail_give_the_same_score(spark):
    df = spark.createDataFrame(corpus(), SCHEMA)
    a, b = ({(r["doc_id"], r["n_tokens"]): r["score"] for r in lm.score(df, head=h).collect()} for h in (200_000, 4))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], rel=1e-6) for k in a)


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET", 8)
    monkeypatch.setattr(lm, "FAN", 2)
    monkeypatch.setattr(lm.train, "__defaults__", (lm.ROUNDS, lm.RATE, 4, 8))
    rows = [(i, " ".join(corpus()[i % 200][1].split() * 9), "x", "y") for i in range(120)]
    a, b = ({r["doc_id"]: r["score"] for r in lm.score(spark.createDataFrame(rows, SCHEMA).repartition(n), batch=4).collect()} for n in (1, 16))
    assert len(a) == 120 and all(a[k] == pytest.approx(b[k], rel=1e-6) for k in a)


def test_context_counts_and_beats_the_base(spark):
    """Words that follow a fixed order: shuffling them lowers a held-out text's score, and the model beats the word counts."""
    cycle = "alpha bravo charlie delta echo foxtrot golf hotel india juliet".split()
    rng = np.random.default_rng(6)
    rows = []
    for i in range(400):
        k = int(rng.integers(0, 10))
        words = [cycle[(k + j) % 10] for j in range(80)]
        rows.append((i, " ".join(words), "x", "y"))
    held = [i for i in range(1000, 1400) if zlib.crc32(str(i).encode()) % 10 == 0][:20]
    for i in held[:10]:
        rows.append((i, " ".join(cycle * 8), "x", "y"))
    for i in held[10:]:
        rows.append((i, " ".join(rng.permutation(cycle * 8)), "x", "y"))
    got = {r["doc_id"]: r for r in lm.score(spark.createDataFrame(rows, SCHEMA), batch=4).collect()}
    ordered, mixed = ([got[i]["score"] for i in part] for part in (held[:10], held[10:]))
    assert min(ordered) > max(mixed) + 10
    assert all(got[i]["held_out"] and got[i]["score"] > got[i]["base_score"] for i in held[:10])


def test_words_and_subwords_line_up():
    s = lm.Spelling(pa.array(["The sea sea", "", " wind\tover"]), default_tokenizer())
    ids, sizes, per_word = s.ids()
    assert per_word.sum() == len(ids) == sizes.sum() and s.per.tolist() == [3, 0, 2] and sizes[1] == 0


def test_no_documents(spark):
    assert lm.score(spark.createDataFrame([], SCHEMA)).collect() == []


def test_held_out_texts_are_likelier_than_noise(spark):
    rows = corpus()[:200]
    noise = [(1000 + i, " ".join("".join(np.random.default_rng(i).choice(list("qxzjkvw"), 6)) for _ in range(20)), "x", "y") for i in range(30)]
    held = lambda d: zlib.crc32(str(d).encode()) % 10 == 0
    got = lm.score(spark.createDataFrame([r for r in rows] + [r for r in noise if held(r[0])], SCHEMA)).filter("held_out").collect()
    mean = lambda rs: sum(r["score"] for r in rs) / sum(r["n_tokens"] for r in rs)
    assert mean([r for r in got if r["doc_id"] < 1000]) > mean([r for r in got if r["doc_id"] >= 1000]) + 1
