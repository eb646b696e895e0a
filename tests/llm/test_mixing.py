"""Targets, thresholds and takes of the mix."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from tidemark.llm import mixing

SCHEMA = "doc_id long, text string, source string, hash string, size string"


def size_of(text):
    return len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w])


def hash_of(doc_id):
    return int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:15], 16)


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, target, capped = sum(sizes.values()), {}, set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        for s in free:
            target[s] = left * weight[s] / sum(weight[x] for x in free)
        over = {s for s in free if target[s] > 3 * sizes[s] + 1e-9}
        for s in over:
            target[s] = 3 * sizes[s]
        if not over:
            return target
        capped |= over


def brute_take(docs, target, size):
    """(taken words by id) for one source."""
    passes = min(3, int(target // size)) if size else 0
    budget, at, extra = target - passes * size, 0, set()
    by_hash = defaultdict(list)
    for d, n in docs:
        by_hash[hash_of(d)].append((d, n))
    for h in sorted(by_hash):
        here = sum(n for _, n in by_hash[h])
        if budget > 0 and (at + here <= budget or at < budget and at + here - budget < budget - at):
            extra.add(h)
        at += here
    return [(d, n * (passes + (hash_of(d) in extra))) for d, n in docs]


def check(spark, rows):
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    per = defaultdict(list)
    for d, t, s, *_ in rows:
        per[s].append((d, size_of(t)))
    sizes = {s: sum(n for _, n in v) for s, v in per.items()}
    target = brute_targets(sizes)
    want = defaultdict(list)
    for s, v in per.items():
        want[s] = sorted(brute_take(v, target[s], sizes[s]), key=repr)
    for s in per:
        mine = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in mine} == {sizes[s]} and all(r["target"] == pytest.approx(target[s]) for r in mine)
        assert sorted(((r["doc_id"], r["taken"]) for r in mine), key=repr) == want[s]
        assert all(r["taken"] <= 3 * r["size"] for r in mine)
    assert len(got) == len(rows)
    return got, target


def test_mix_of_many_sources(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "b", "c", "d", "d", "d", "d", "é", None]), "x", "y") for i in range(800)]
    got, target = check(spark, rows)
    for s, t in target.items():
        taken = sum(r["taken"] for r in got if r["source"] == s)
        assert abs(taken - t) <= 60
    again = mixing.mix(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in got)


def test_mix_of_odd_rows(spark):
    check(spark, [(1, None, "a", "", ""), (2, "", "b", "", ""), (3, "one two three", "b", "", ""), (3, "one two three", "b", "", ""), (None, "x y", None, "", ""), (9, "z " * 50_000, "c", "", "")])


def test_mix_without_words_and_of_nothing(spark):
    check(spark, [(1, None, "a", "", ""), (2, " ", "b", "", "")])
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []


def test_mixed_documents_come_as_often_as_taken(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(["a", "b", "b", "b", "c"]), "x", "y") for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    times = {r["doc_id"]: r["times"] for r in mixing.mix(df).collect() if r["size"]}
    out = mixing.mixed(df)
    seen = defaultdict(int)
    for r in out.collect():
        seen[r["doc_id"]] += 1
    assert out.columns == df.columns and dict(seen) == {d: n for d, n in times.items() if n}


def test_mixed_without_open_budgets(spark):
    df = spark.createDataFrame([(1, "a b", "s", "", ""), (2, "c d", "s", "", "")], SCHEMA)
    assert sorted(r["doc_id"] for r in mixing.mixed(df).collect()) == [1, 2]


def test_columns_of_any_name_pass_through(spark):
    docs = spark.createDataFrame([(i, "a b c", f"s{i % 2}", "1", "2", "3", "4") for i in range(20)], "doc_id long, text string, source string, _p string, _copy string, mix_goal string, Mix_Copy string")
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and {tuple(r)[3:] for r in out.collect()} == {("1", "2", "3", "4")}
