"""Language identification: accuracy, evidence and odd rows."""

from __future__ import annotations

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import common
from tidemark.llm import language_id as li

DOCS, PAGES = "doc_id long, text string, lang string, host string", "page_id long, url string, html string, declared string"
WORDS = {"en": ["the", "and", "there", "with", "water", "house"], "fr": ["le", "être", "où", "maison", "avec", "eau"], "de": ["der", "über", "und", "wasser", "straße", "haus"]}


def text(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(1)
    docs = [(i, text(rng, lang, 40), lang, "x") for i, lang in enumerate(["en", "fr", "de"] * 40)]
    pages = []
    for i in range(300):
        lang = ["en", "fr", "de"][i % 3]
        host = f"www.site{i % 3}.example.{['com', 'fr', 'de'][i % 3]}" if i % 10 else "hot.example.com"
        body = text(rng, lang, rng.choice([0, 1, 30]))
        pages.append((i, f"https://{host}/p{i}", f'<html lang="{lang}"><script>le le le</script><p>{body}</p></html>' if i % 4 else f"<html><p>{body}</p></html>", "x"))
    return li.identify(spark.createDataFrame(pages, PAGES), spark.createDataFrame(docs, DOCS)).collect(), pages


def test_accuracy(judged):
    rows, pages = judged
    right = [(r["lang"] == ["en", "fr", "de"][r["page_id"] % 3]) for r in rows if r["page_id"] is not None]
    assert len(right) == len(pages) and sum(right) / len(right) > 0.93
    assert all(r["lang"] == ["en", "fr", "de"][r["doc_id"] % 3] for r in rows if r["doc_id"] is not None)
    assert all(0 < r["probability"] <= 1 + 1e-9 for r in rows)


def test_evidence_helps_where_there_is_no_text(judged):
    rows, _ = judged
    empty = [r for r in rows if r["page_id"] is not None and r["text_lang"] is None and r["host"] != "hot.example.com"]
    assert empty and sum(r["lang"] == ["en", "fr", "de"][r["page_id"] % 3] for r in empty) / len(empty) > 0.8


def softmax(x):
    e = np.exp(x - x.max())
    return e / e.sum()


def test_whole_result_matches_brute_force(judged):
    """The fusion record by record: likelihood, declared language, and priors of host, domain, suffix and all without the record itself."""
    rows, pages = judged
    rng = random.Random(1)
    docs = [(text(rng, lang, 40), lang) for lang in ["en", "fr", "de"] * 40]
    langs, table = li.model({k: np.bincount(li.trigrams(pa.array([t for t, x in docs if x == k]))[0], minlength=li.BUCKETS) for k in ("en", "fr", "de")})
    records = [(i, None, None, t) for i, (t, _) in enumerate(docs)]
    for i, url, html, _ in pages:
        said = re.search(r'lang="(..)"', html)
        records.append((1000 + i, url.split("/")[2], said and said[1], li.visible(html)))
    logs, first = {}, {}
    for i, _, _, t in records:
        bucket, _ = li.trigrams(pa.array([t]))
        logs[i] = table[:, bucket].sum(axis=1) * (min(len(bucket), li.FULL) / max(1, len(bucket)))
        first[i] = softmax(logs[i])
    total = lambda ids: sum((first[i] for i in ids), np.zeros(3))
    shrunk = lambda c, up: (c + li.SHRINK * up) / (c.sum() + li.SHRINK)
    world = total(first)
    host = {i: h for i, h, *_ in records if h}
    domain, suffix = (lambda h: ".".join(h.split(".")[-2:])), (lambda h: h.split(".")[-1])
    got = {(r["doc_id"] if r["page_id"] is None else 1000 + r["page_id"]): r for r in rows}
    assert len(got) == len(records)
    for i, h, said, _ in records:
        prior = (world + li.SHRINK / 3) / (world.sum() + li.SHRINK)
        everything = prior
        if h:
            for level in (suffix, domain):
                prior = shrunk(total(j for j, g in host.items() if level(g) == level(h)), prior)
            prior = shrunk(np.maximum(total(j for j, g in host.items() if g == h) - first[i], 0), prior)
        else:
            prior = everything
        x = logs[i] + np.log(prior + 1e-12)
        if said:
            x = x + np.log((total(j for j, _, s, _ in records if s == said) + 0.5) / (world + 1))
        p = softmax(x)
        assert got[i]["probability"] == pytest.approx(p.max(), rel=1e-6) and got[i]["lang"] == langs[int(p.argmax())], i


def test_hot_hosts_get_the_same_priors(spark, judged, monkeypatch):
    rows, pages = judged
    rng = random.Random(1)
    docs = [(i, text(rng, lang, 40), lang, "x") for i, lang in enumerate(["en", "fr", "de"] * 40)]
    monkeypatch.setattr(common, "HOT_KEYS", 2)  # a host must hold half of the records: none is broadcast
    again = li.identify(spark.createDataFrame(pages, PAGES), spark.createDataFrame(docs, DOCS)).collect()
    key = lambda r: (r["doc_id"] or -1, r["page_id"] or -1)
    for a, b in zip(sorted(rows, key=key), sorted(again, key=key), strict=True):
        assert a["lang"] == b["lang"] and a["probability"] == pytest.approx(b["probability"], rel=1e-9)


def test_unclosed_elements_take_linear_time():
    assert li.visible("a<script>x</script>b<!-- c -->d<style>e").split() == ["a", "b", "d", "e"]
    began = time.time()
    for part in ("<script ", "<!--", "<style>", "<script><!--"):
        li.visible(part * 100_000)
    assert time.time() - began < 5


def test_extractors(spark):
    df = spark.createDataFrame([("HTTPS://user@Www.A.com:80/x", "<HTML class=a LANG='EN-us'>"), (None, None), ("nonsense", "<html>")], "u string, h string")
    got = [tuple(r) for r in df.select(li.host_of(df["u"]).alias("a"), li.declared_of(df["h"]).alias("b")).collect()]
    assert got == [("www.a.com", "en"), (None, None), (None, None)]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "the house", "en", ""), (2, None, "fr", ""), (None, "le", "fr", ""), (4, "x " * 50_000, None, ""), (4, "x " * 50_000, None, "")], DOCS)
    pages = spark.createDataFrame([(None, None, None, ""), (1, "http://a.b/", "", ""), (1, "http://a.b/", "", "")], PAGES)
    assert len(li.identify(pages, docs).collect()) == 8
    nothing = spark.createDataFrame([], DOCS)
    assert all(r["lang"] is None for r in li.identify(pages, nothing).collect()) and li.identify(None, docs).count() == 5
    assert li.identify(spark.createDataFrame([], PAGES), docs, judge_docs=False).collect() == []
