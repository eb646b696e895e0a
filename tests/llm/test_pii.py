"""Personal data: base patterns against their plain regular expressions, and what the trees add."""

from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np

from tidemark.llm import pii
from tidemark.llm.boosting import Boosted, cautious_threshold

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 14 <= len(digits) <= 19 and pii.luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=pii._order)


def test_base_equals_the_plain_patterns():
    rng = random.Random(1)
    for alphabet, n in (("a@.@-1234 5+().%x9 ", 20_000), ("0123456789 -", 5_000), ("+1 ().-9", 5_000), ("ab@.é", 5_000)):
        for _ in range(n):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            assert pii.base_spans(t) == plain(t)


def test_long_runs_take_linear_time():
    began = time.time()
    for t in ("1" * 300_000, "a" * 300_000 + "@", "@" * 300_000, "+1 " * 100_000, "1." * 150_000, "1-" * 150_000, "(" * 100_000 + "1"):
        base = pii.base_spans(t)
        pii.added_spans(t, base, *pii.trained())
    assert time.time() - began < 60


def test_scores_of_equal_surroundings_are_shared_without_a_change(monkeypatch):
    rng = np.random.default_rng(4)
    text = " ".join(pii.made_up(rng)[0] for _ in range(60)) + " 1-2-3" * 400
    model, least = pii.trained()
    base = pii.base_spans(text)
    once = pii.added_spans(text, base, model, least)
    monkeypatch.setattr(pii, "SCORED", 7)
    assert pii.added_spans(text, base, model, least) == once
    monkeypatch.setattr(pii, "_surroundings", lambda text, c: c)
    assert pii.added_spans(text, base, model, least) == once and once


def test_neighbours_that_spoil_each_other_are_added():
    t = "call +1 (269) 555-3296 4524132264652876 and so on"
    assert pii.base_spans(t) == []
    got = pii.added_spans(t, [], *pii.trained())
    assert {(k, t[a:b]) for k, a, b in got} == {("phone", "+1 (269) 555-3296"), ("card", "4524132264652876")}
    assert pii.redact(t, got) == "call [phone] [card] and so on"


def test_held_out_precision_and_recall():
    rng = np.random.default_rng(99)
    model, least = pii.trained()
    hits = found = real = 0
    for _ in range(400):
        text, truth = pii.made_up(rng)
        base = pii.base_spans(text)
        added = pii.added_spans(text, base, model, least)
        rest = {s for s in truth if s not in base and not any(s[1] < b and a < s[2] for _, a, b in base)}
        hits, found, real = hits + len(set(added) & rest), found + len(added), real + len(rest)
    assert hits / found > 0.97 and hits / real > 0.7


def test_generators_propose_what_they_are_for():
    for t, kind in (
        ("0049 30 12 34 56 78 9", "phone"), ("41 11 11 11 11 11 11 11", "card"), ("bob@example[dot]com", "email"), ("bob@example (dot) com", "email"), ("bob (At) example.com", "email"), ("bob at example dot com", "email"),
        ("a.b [at] mail.dept.example.co.uk", "email"), ("x" * 60 + " [at] " + "y" * 60 + "." + "z" * 60 + ".com", "email"), ("cb1a9fee807a05366fcb8b6c95c7c565ede51a72", "secret"),
    ):
        for around in ("{}", "12 {} 34", "say {}, then"):
            text = around.format(t)
            assert (kind, text.index(t), text.index(t) + len(t)) in pii.candidates(text), text


def test_recall_of_the_generators():
    rng = np.random.default_rng(17)
    real = found = 0
    for _ in range(500):
        text, truth = pii.made_up(rng)
        proposed = set(pii.candidates(text)) | set(pii.base_spans(text))
        real, found = real + len(truth), found + sum(t in proposed for t in truth)
    assert found / real > 0.99


def test_added_spans_match_brute_force():
    """All candidates against all base spans, the best first."""
    rng = np.random.default_rng(3)
    model, least = pii.trained()
    for _ in range(150):
        text = " ".join(pii.made_up(rng)[0] for _ in range(3))
        base = pii.base_spans(text)
        apart = lambda c, spans: not any(c[1] < b and a < c[2] for _, a, b in spans)
        free = [c for c in pii.candidates(text) if apart(c, base)]
        want: list = []
        if free:
            prob = model.probability(np.array([pii.features(text, c) for c in free]))
            for p, _, _, i in sorted((-p, c[1] - c[2], c[1], i) for i, (p, c) in enumerate(zip(prob, free, strict=True))):
                if -p >= least[free[i][0]] and apart(free[i], want):
                    want.append(free[i])
        assert pii.added_spans(text, base, model, least) == want


def test_nothing_is_added_inside_a_long_base_span():
    model, least = pii.trained()
    for n in (63, 64, 65, 200):
        text = "call " + "_".join(["1.2.3.4"] * n) + "_269-555-3296@example.com"
        base = pii.base_spans(text)
        assert base[0][0] == "email" and len(base) >= n and pii.added_spans(text, base, model, least) == []


def test_overlapping_spans_are_redacted_together():
    text = "4111 1111 1111 1111@evil.com and a@b.co"
    assert pii.redact(text, pii.base_spans(text)) == "[card/email] and [email]"


def test_secrets_have_columns_of_their_own(spark):
    rows = [(1, 'here token = "cb1a9fee807a05366fcb8b6c95c7c565ede51a72" and a@b.co'), (2, "commit cb1a9fee807a05366fcb8b6c95c7c565ede51a72 of the file")]
    got = sorted(tuple(r) for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "spans", "secrets", "n_found").collect())
    assert got == [(1, "email:60:66", "secret:14:54", 2), (2, "", "", 0)]


def test_ordinary_numbers_are_left_alone():
    model, least = pii.trained()
    for t in ("Licensed under version 2.0 of 2004.", "On 2024-01-05 10:20 we met.", "isbn 9783161484100 page 12", "order 123456789", "he was at home. then he left", "It costs 12.50 or 1200 a year"):
        assert pii.base_spans(t) + pii.added_spans(t, pii.base_spans(t), model, least) == []


def test_boosting_learns_and_calibrates():
    rng = np.random.default_rng(5)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    m = Boosted(rounds=40).fit(x[:2000], y[:2000]).calibrate(x[2000:2500], y[2000:2500])
    p = m.probability(x[2500:])
    assert ((p > 0.5) == y[2500:]).mean() > 0.97
    assert cautious_threshold(np.array([0.9, 0.8, 0.7]), np.array([1.0, 1.0, 0.0]), 0.99) == 0.8


def test_query_columns_on_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a@b.co", "x"), (3, "mail é a@b.co 1.2.3.4 +12 345 678 901", "x"), (3, "x " * 60_000 + "a@b.co", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted(pii.find_pii(df, with_text=True).collect(), key=repr)
    assert len(got) == len(rows)
    for r, (d, t, _) in zip(sorted(got, key=lambda r: (repr(r["doc_id"]), len(r["redacted"]))), sorted(rows, key=lambda r: (repr(r[0]), len(r[1] or ""))), strict=True):
        base = plain(t or "")
        assert r["doc_id"] == d and [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(pii.joined(base).encode()).hexdigest() and pii.joined(base) in r["spans"]
    assert pii.find_pii(spark.createDataFrame([], df.schema)).collect() == []
