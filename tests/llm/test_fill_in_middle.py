"""Fill-in-the-middle: rank and select, cuts, and texts rebuilt from what was written."""

from __future__ import annotations

import hashlib
import random

import numpy as np

from tests.llm.test_oracles_llm import compare_tables
from tidemark.llm import fill_in_middle as fim

SCHEMA = "doc_id long, text string, n string, output string, form int"


def plain_way(doc_id, text):
    """The same rearrangement, code point by code point."""
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return doc_id, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_rank_and_select():
    rng = random.Random(3)
    for size in (0, 1, 63, 64, 65, 511, 512, 513, 5000):
        text = "".join(rng.choice("aé中\U0001f600") for _ in range(size))
        data = np.frombuffer(text.encode(), np.uint8)
        starts = np.flatnonzero((data & 0xC0) != 0x80)
        marks = fim.Boundaries(data)
        assert marks.before[-1] == size
        at = np.arange(len(data) + 1)
        assert np.array_equal(marks.rank(at), np.searchsorted(starts, at))
        assert np.array_equal(marks.select(np.arange(size + 1), len(data)), np.append(starts, len(data)))


def rows():
    rng = random.Random(5)
    alphabet = "ab <>PSM\né中\U0001f600́"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += [None, "", "<", "<P", "<P>", "a<S>b", "<M>", "x<<S", "S>", "\U0001f600", "no spaces", "中" * 300_000, "aé" * 2_000_000]
    return [(i, t, "x", "y", 1) for i, t in enumerate(texts)] + [(None, "null id", None, None, None), (7, "twice", None, None, None), (7, "twice", None, None, None)]


def test_equals_the_plain_way_and_comes_back(spark):
    given = rows()
    docs = spark.createDataFrame(given, SCHEMA)
    out = fim.fill_in_middle(docs)
    key = lambda r: (r[0] is None, r[0], r[5])
    assert sorted((tuple(r) for r in out.collect()), key=key) == sorted((plain_way(i, t) for i, t, *_ in given), key=key)
    assert {r["form"] for r in out.select("form").distinct().collect()} == {"plain", "psm", "spm"}
    back = out.select("doc_id", fim.restored(out["form"], out["output"]).alias("text")).collect()
    assert sorted(map(repr, map(tuple, back))) == sorted(repr((i, t or "")) for i, t, *_ in given)


def test_same_rows_for_any_partitioning_and_empty_tables(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    one, many = (sorted(map(repr, fim.digests(docs.repartition(n)).collect())) for n in (1, 7))
    assert one == many
    assert fim.digests(docs.limit(0)).collect() == []


def test_sql(spark):
    small = [r for r in rows() if r[1] is None or len(r[1]) < 1000]
    compare_tables(spark, fim.digests, fim.ORACLE, {"documents": (small, SCHEMA)})
