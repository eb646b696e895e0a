"""Decontamination against edit distances by brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa

from tidemark.llm import decontaminate as d

DOCS, ITEMS = "doc_id long, text string, item_id string, start string", "item_id long, text string, edits string"
ALPHABET = "abcdefghijklmnopqrstuvwxyz    "


def semi_global(pattern, text):
    """Least edits of the pattern against any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def edited(rng, s, n):
    s = list(s)
    for _ in range(min(n, len(s) - 1)):
        k, at = rng.randrange(3), rng.randrange(len(s))
        if k == 0:
            s[at] = rng.choice(ALPHABET)
        elif k == 1:
            s.insert(at, rng.choice(ALPHABET))
        else:
            del s[at]
    return "".join(s)


def make(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice(ALPHABET) for _ in range(n)).strip() or "xyz"
    items = [(i, text(rng.choice([3, 7, 20, 30, 45, 60, 100, 130, 260])), "x") for i in range(14)]
    docs = []
    for i in range(60):
        body = text(rng.randint(0, 400))
        if i % 2:
            passage = edited(rng, rng.choice(items)[1], rng.choice([0, 1, 3, 6, 12]))
            body = body + " " + passage.upper().replace(" ", " \n") + " " + text(rng.randint(0, 200))
        docs.append((i, body, "x", "y"))
    return docs, items


def brute(docs, items):
    out = set()
    segments = d.build_index([(i, t) for i, t, _ in items])
    for doc, t, *_ in docs:
        for item, codes in zip(segments.item.tolist(), segments.codes, strict=True):
            pattern = "".join(map(chr, codes))
            if len(pattern) < d.SHORTEST:
                found = re.search(r"(?<![^\W_])" + re.escape(pattern) + r"(?![^\W_])", plain(t)) is not None
            else:
                found = semi_global(pattern, plain(t)) <= d.allowed(len(pattern))
            if found:
                out.add((doc, item))
    return out


def test_matches_brute_force(spark):
    for seed in (1, 2):
        docs, items = make(seed)
        frame, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
        want = brute(docs, items)
        rows = d.find_leaks(frame, bench).collect()
        assert {(r["doc_id"], r["item_id"]) for r in rows} == want and len(rows) == len(want) and want
        kept = d.keep_clean(frame, bench)
        assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == {i for i, *_ in docs} - {i for i, _ in want}


def test_places_point_at_the_passage(spark):
    item = "The quick brown fox jumps over the lazy dog while nobody is looking at it."
    text = "é" * 30 + " \n  " + item + " and so on"
    r = d.find_leaks(spark.createDataFrame([(1, text, "", "")], DOCS), spark.createDataFrame([(7, item, "")], ITEMS)).first()
    assert (r["item_id"], r["edits"]) == (7, 0) and text[r["start"] : r["end"]] == item


def test_excerpts_from_any_place_are_found():
    """Verbatim excerpts of a segment and a stride, cut anywhere, in other text."""
    rng = random.Random(8)
    items = [(i, "".join(rng.choice(ALPHABET) for _ in range(rng.randint(59, 400)))) for i in range(40)]
    index = d.build_index(items)
    texts = []
    for _, t in items:
        t = plain(t).strip()
        n = min(len(t), d.SEGMENT + d.STRIDE - 1)
        at = rng.randint(0, len(t) - n)
        texts.append("".join(rng.choice(ALPHABET) for _ in range(100)) + t[at : at + n].upper() + "".join(rng.choice(ALPHABET) for _ in range(100)))
    m = d.matches(pa.array(texts), index)
    assert {(int(a), int(b)) for a, b in zip(m["doc"], index.item[m["segment"]], strict=True)} == {(i, i) for i in range(40)}


def test_short_items_match_whole_and_alone(spark):
    items = spark.createDataFrame([(-5, "What is the capital of France?", ""), (2, "42", ""), (3, "Yes", "")], ITEMS)
    texts = ["so: what is  the Capital of france? Paris", "what is the capital of Franc?", "in 1942", "it is 42.", "yesterday", "Yes", "no, yes"]
    docs = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], DOCS)
    assert sorted((r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, items).collect()) == [(0, -5), (3, 2), (5, 3), (6, 3)]


def test_texts_of_one_id_in_several_blocks_are_one_item(spark, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_CHARS", 60)
    parts = ["the quick brown fox jumps over the lazy dog while it sleeps in the sun", "and then a very different passage of text follows the first one here"]
    items = spark.createDataFrame([(k, p, "") for k in (-1, None) for p in parts], ITEMS)
    docs = spark.createDataFrame([(1, " ".join(parts), "", ""), (1, " ".join(parts), "", "")], DOCS)
    assert sorted(((r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, items).collect()), key=repr) == [(1, -1), (1, -1), (1, None), (1, None)]


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    docs, items = make(3)
    frame, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    one = {(r["doc_id"], r["item_id"]) for r in d.find_leaks(frame, bench).collect()}
    monkeypatch.setattr(d, "BLOCK_CHARS", 300)
    assert {(r["doc_id"], r["item_id"]) for r in d.find_leaks(frame, bench).collect()} == one


def test_chunk_borders_do_not_matter():
    docs, items = make(4)
    index = d.build_index([(i, t) for i, t, _ in items])
    whole = d.matches(pa.array([t for _, t, *_ in docs]), index)
    together = {(int(a), int(b)) for a, b in zip(whole["doc"], whole["segment"], strict=True)}
    alone = {(i, int(s)) for i, (_, t, *_) in enumerate(docs) for s in d.matches(pa.array([t]), index)["segment"]}
    assert together == alone


def test_rolling_hash():
    codes = np.array([ord(c) for c in "abcabcabcabcabc"], np.uint32)
    h = d.qgram_hashes(codes, 10)
    assert len(h) == 6 and h[0] == h[3] and len(set(h.tolist())) == 3


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "x " * 60_000, "", ""), (1, None, "", ""), (2, "", "", "")], DOCS)
    items = spark.createDataFrame([(None, "x " * 60, ""), (1, None, ""), (2, "", ""), (3, "short", "")], ITEMS)
    assert {(r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, items).collect()} == {(None, None)}  # a short item must stand alone
    assert d.find_leaks(docs, spark.createDataFrame([], ITEMS)).collect() == [] and d.keep_clean(docs, spark.createDataFrame([], ITEMS)).count() == 3
    assert d.find_leaks(spark.createDataFrame([], DOCS), items).collect() == []
