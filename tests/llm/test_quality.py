"""Importance resampling: models, noise, top k, and what is kept."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import quality

DOCS, LABELS = "doc_id long, text string, key string, kept string", "doc_id long, quality int, toxic int"


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    good = lambda: " ".join(rng.choice(["the", "sea", "wind", "runs", "over", "sand", "and", "stone."]) for _ in range(rng.randint(20, 80)))
    bad = lambda: " ".join(rng.choice(["buy", "now"]) + rng.choice(["###", "%%%"]) for _ in range(rng.randint(20, 80)))
    rows = [(i, bad() if i % 5 == 0 else good(), "x", "y") for i in range(n)]
    return rows, [(i, int(i % 5 != 0), 0) for i in range(0, n, 2)]


def test_good_stay_and_bad_go(spark):
    rows, labels = corpus()
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    got = {r["doc_id"]: r["kept"] for r in quality.quality(docs, marks).collect()}
    assert sum(got[i] == (i % 5 != 0) for i in got) >= 0.99 * len(rows)
    kept = quality.keep_good(docs, marks)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, k in got.items() if k}


def test_ngrams_match_brute_force():
    import re

    texts = ["The sea, the SEA!!", "", "a_b  c", "é é é"]
    bucket, doc = quality.ngram_buckets(pa.array(texts))
    for i, t in enumerate(texts):
        tokens = re.findall(r"[0-9A-Za-z_\x80-￿]+|[^\x20\x09-\x0D0-9A-Za-z_\x80-￿]+", t)
        assert (doc == i).sum() == len(tokens) + max(0, len(tokens) - 1)
    assert bucket[doc == 0][0] == bucket[doc == 0][3]  # "the" and "The"
    assert len(set(bucket[(doc == 3)].tolist())) == 2  # one token, one pair of equals


@pytest.mark.parametrize("k", [1, 7, 500, 999, 1000])
def test_kth_largest(spark, k):
    rng = random.Random(3)
    rows = [(i, float(rng.choice([1, 2, 2, 3, rng.random()]))) for i in range(1000)]
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    key, doc = quality.kth_largest(spark.createDataFrame(rows, "doc_id long, key double"), k)
    assert (key, doc) == (order[k - 1][1], order[k - 1][0])


def test_kth_largest_by_refining(spark, monkeypatch):
    monkeypatch.setattr(quality, "FEW", 5)
    monkeypatch.setattr(quality, "BINS", 8)
    rows = [(i, float(i * i % 997)) for i in range(900)]
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert quality.kth_largest(spark.createDataFrame(rows, "doc_id long, key double"), 300)[0] == order[299][1]


def test_gumbel_noise_is_standard(spark):
    keys = spark.range(20_000).selectExpr("id AS doc_id", "0.0D AS log_weight").select(quality.gumbel_key().alias("k")).toPandas()["k"]
    assert abs(keys.mean() - 0.5772) < 0.03 and abs(keys.var() - np.pi**2 / 6) < 0.06


def test_threshold():
    assert quality.threshold([(0.0, False), (1.0, False), (2.0, True), (3.0, True)]) == 1.5
    assert quality.threshold([]) == quality.threshold([(1.0, True)]) == -np.inf


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "", ""), (2, "", "", ""), (None, "x", "", ""), (3, "a " * 50_000, "", ""), (3, "a " * 50_000, "", "")], DOCS)
    nothing = spark.createDataFrame([], LABELS)
    assert all(r["kept"] for r in quality.quality(docs, nothing).collect())
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 0), (2, None, 0), (1, 1, None)], LABELS)
    assert quality.quality(docs, labels).count() == 5 and quality.keep_good(docs, labels).count() <= 5
    assert quality.quality(spark.createDataFrame([], DOCS), labels).collect() == []


def test_toxic_documents_go_and_clean_ones_stay(spark):
    """Half of the documents are labelled; the others are judged by what was learned."""
    rng = random.Random(5)
    rows, labels = corpus(1200, seed=5)
    words = ["idiocy", "filthy", "vermin"]
    toxic = {i for i in range(1200) if i % 5 and i % 7 == 0}
    rows = [(i, t + "".join(f" {rng.choice(words)} stone." for _ in range(3)) if i in toxic else t, a, b) for i, t, a, b in rows]
    labels = [(i, q, int(i in toxic)) for i, q, _ in labels]
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    kept = {r["doc_id"] for r in quality.keep_good(docs, marks).collect()}
    clean = {i for i in range(1200) if i % 5} - toxic
    assert not kept & {i for i in toxic if i % 2} and len(kept & clean) >= 0.97 * len(clean)


def test_whole_result_matches_brute_force(spark):
    """Counts, weights, evidence, thresholds and the top k, with loops instead of tables."""
    rows, labels = corpus(300, seed=9)
    rows = [(i, t + (" vermin stone." if i % 11 == 0 else ""), a, b) for i, t, a, b in rows]
    labels = [(i, q, int(i % 11 == 0)) for i, q, _ in labels]
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    half = {r["label_id"]: r["fits"] for r in quality.labelled_sample(marks).collect()}
    grams = {i: quality.ngram_buckets(pa.array([t]))[0].tolist() for i, t, *_ in rows}
    few = {i: set(quality.ngram_buckets(pa.array([t]), quality.TOXIC_BUCKETS)[0].tolist()) for i, t, *_ in rows}
    label = {i: (q == 1 and not t, bool(t)) for i, q, t in labels}
    raw, good, bad, other = (Counter() for _ in range(4))
    for i in grams:
        raw.update(grams[i])
        if half.get(i):
            good.update(grams[i] if label[i][0] else [])
            (bad if label[i][1] else other).update(few[i])
    log = lambda c, g: math.log((c[g] + 1) / (sum(c.values()) + quality.BUCKETS))
    weight = {i: sum(log(good, g) - log(raw, g) for g in gs) for i, gs in grams.items()}
    rate = sum(half[i] and label[i][1] for i in label) / sum(half[i] and not label[i][1] for i in label)
    told = {g: math.log((bad[g] + 1) / (other[g] * rate + 1)) for g in set(bad) | set(other)}
    evidence = {i: sum(told[g] for g in gs if g in told and told[g] >= quality.TELLING) for i, gs in few.items()}
    apart = [i for i in label if not half[i]]
    limit = quality.highest_evidence([(evidence[i], label[i][1]) for i in apart])
    least = quality.threshold([(weight[i], label[i][0]) for i in apart if evidence[i] <= limit])
    got = {r["doc_id"]: r for r in quality.quality(docs, marks).collect()}
    assert all(r["log_weight"] == pytest.approx(weight[i]) and r["evidence"] == pytest.approx(evidence[i]) for i, r in got.items())
    drawn = [i for i in weight if evidence[i] <= limit]
    k = sum(weight[i] >= least for i in drawn)
    best = sorted(drawn, key=lambda i: (-got[i]["key"], i))[:k]
    assert {i for i, r in got.items() if r["kept"]} == set(best) and 0 < k < 300


def test_limit_of_the_evidence():
    assert quality.highest_evidence([(float(i), False) for i in range(1000)] + [(5.0, True)]) == 994.0
    assert quality.highest_evidence([]) == quality.highest_evidence([(1.0, False)]) == np.inf


def test_clashing_columns_pass_through(spark):
    rows, labels = corpus(60)
    names = "doc_id long, text string, sized string, log_weight string, evidence string, Key string, _key string"
    docs = spark.createDataFrame([(i, t, "a", "b", "c", "d", "e") for i, t, *_ in rows], names)
    kept = quality.keep_good(docs, spark.createDataFrame(labels, LABELS))
    assert kept.columns == docs.columns and {tuple(r)[2:] for r in kept.collect()} == {("a", "b", "c", "d", "e")}
