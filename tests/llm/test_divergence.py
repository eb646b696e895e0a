"""Source divergence against its SQL, which sums over every term of every pair."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest

from tests.llm.test_oracles_llm import compare_tables
from tidemark.llm import divergence as dv

SCHEMA = "doc_id long, text string, lang string, source string, part string, rank string, term string"


def docs(seed=1, n=300):
    rng = random.Random(seed)
    words = ["Wind", "wind", "WIND", "sea", "a", "aa", "aaa", "Été", "été", "中文", "中", "x1y", "it's", "l" * 250, "l" * 249, "中" * 90, "KK"]
    words += [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    between = [" ", "  ", "\n", "-", ", ", "\x00", "7", "_", "@[`{\x7f"]
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice(["s1", "s1", "s1", "s2", "s3", None, ""])
        body = "".join(rng.choice(words[: rng.choice((8, 20, len(words)))]) + rng.choice(between) for _ in range(rng.randrange(1, 60)))
        rows.append((i, body, lang, source, "x", "y", "z"))
    rows += [(None, None, "fr", "only", None, None, None), (1, "one two", "fr", "other", None, None, None), (1, "", "it", "s1", None, None, None), (1, "12 34", "en", "no terms", None, None, None)]
    return rows + [(9, "same text here", "es", "s1", None, None, None)] * 4 + [(9, "same text", "es", "s2", None, None, None)]


def test_equals_sql(spark):
    compare_tables(spark, dv.audit, dv.ORACLE, {"documents": (docs(), SCHEMA)})


@pytest.mark.parametrize(("block", "held"), [(400, 50), (3000, 7), (60_000, 7)])
def test_vocabularies_of_several_blocks_and_counts_handed_on_early(spark, monkeypatch, block, held):
    monkeypatch.setattr(dv, "BLOCK_BYTES", block)
    monkeypatch.setattr(dv, "HELD", held)
    compare_tables(spark, dv.audit, dv.ORACLE, {"documents": (docs(2, 120), SCHEMA)})


def test_top_terms_with_ties(spark, monkeypatch):
    rows = [(i, " ".join(f"t{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(300)), "en", "s1", None, None, None) for i in range(3)] + [(9, "other", "en", "s2", None, None, None)]
    compare_tables(spark, dv.audit, dv.ORACLE, {"documents": (rows, SCHEMA)})
    got = dv.audit(spark.createDataFrame(rows, SCHEMA)).filter("part = 'term'")
    assert got.count() == 0  # no term is more frequent in s1 than in its language: s2's only one is not kept


def test_terms_of_equal_value_are_ranked_by_their_bytes(spark):
    rows = [(i, " ".join(f"t{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(300)), "en", "s1", None, None, None) for i in range(3)]
    rows += [(i, "sea sea", "en", "s2", None, None, None) for i in range(3)]
    compare_tables(spark, dv.audit, dv.ORACLE, {"documents": (rows, SCHEMA)})
    got = [r["item"] for r in dv.audit(spark.createDataFrame(rows, SCHEMA)).filter("part = 'term' and source = 's1'").orderBy("rank").collect()]
    assert len(got) == 200 and got == sorted(got)


def test_no_rows_and_long_texts(spark):
    assert dv.audit(spark.createDataFrame([], SCHEMA)).collect() == []
    long_ = [(i, ("sea wind " * 200_000) + "b" * 400_000, "en", f"s{i % 2}", None, None, None) for i in range(4)]
    rows = [*long_, (9, "wind", "en", "s0", None, None, None)]
    compare_tables(spark, dv.audit, dv.ORACLE, {"documents": (rows, SCHEMA)})


def test_long_terms_are_found_by_stretches():
    for size in (0, 1, dv.LONG - 1, dv.LONG, dv.LONG + 1, 3 * dv.LONG):
        for head in (b"", b" ", b"a" * dv.LONG + b" ", b"b c " * 99):
            for tail in (b"", b" ", b" d" * dv.LONG):
                raw = head + b"x" * size + tail
                assert dv._has_long(raw) == (dv._LONG.search(raw) is not None)


def test_the_automaton_reads_each_term_of_a_chunk_once(monkeypatch):
    """Its work follows the distinct terms of a chunk, not the text; the counts are those of the text."""
    read, numbers = [], dv._numbers
    monkeypatch.setattr(dv, "_numbers", lambda automaton, terms: (read.extend(terms), numbers(automaton, terms))[1])
    long_ = "x" * (dv.LONG + 1)

    class Shared:
        value = dv.Vocabulary({"en": ["sea", "été", long_], "": ["wind"]})

    texts = [("en", "a", f"Sea sea, wind\n{long_} seas"), ("en", "b", "été sea " * 1000), ("", "a", "wind sea"), ("en", "a", None), ("fr", "a", "sea"), ("en", "a", "wind" + "y" * dv.LONG)]
    batch = pa.record_batch([pa.array(c, pa.string()) for c in zip(*texts, strict=True)], ["lang", "source", "text"])
    got = [tuple(r.values()) for b in dv._occurrences(Shared)(iter([batch])) for r in b.to_pylist()]
    assert sorted(got) == [("", "a", "wind", 1), ("en", "a", "sea", 2), ("en", "a", long_, 1), ("en", "b", "sea", 1000), ("en", "b", "été", 1000)]
    assert len(read) == len(set(read[:6])) + 2  # six of English, two of no language


def test_texts_that_touch_share_no_term():
    terms, which, text = dv._terms_in(pa.array(["", "Sea", "sea wind", "", "7", "wind", ""])[1:])
    assert [(terms[w].as_py(), t) for w, t in zip(which.tolist(), text.tolist(), strict=True)] == [(b"sea", 0), (b"sea", 1), (b"wind", 1), (b"wind", 4)]
