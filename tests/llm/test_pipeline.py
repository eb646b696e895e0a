"""The corpus pipeline, stage by stage, against brute force on a small corpus; and the queries with SQL."""

from __future__ import annotations

import os
import random

import pytest

import corpus_pipeline
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_dedup import brute_groups
from tests.llm.test_tokens import brute as brute_tokens
from tidemark.llm import mixing, quality, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(7)
    words = [a + b for a in ("sea", "wind", "stone", "run", "over", "sand") for b in ("", "s", "ing", "er", "ly", "ness", "ful")]
    item = lambda: " ".join(rng.choice(words) for _ in range(30))
    items = [(i, item()) for i in range(5)]
    docs = []
    for i in range(300):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(30, 150)))
        if i % 6 == 0:
            text = " ".join(rng.choice(words) + "###" for _ in range(60))
        elif i % 10 == 1:
            text += " " + rng.choice(items)[1] + " " + rng.choice(words)
        elif docs and i % 10 == 3:
            text = rng.choice(docs)[1]
        docs.append((i, text, "en", f"s{i % 4}", len(text)))
    out = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(i, int(i % 6 != 0), 0) for i in range(0, 300, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out, docs, items


def test_stages_match_brute_force(spark, folder):
    out, docs, items = folder
    frame = spark.read.parquet(f"{out}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, frame, out)
        if name != "tokens":
            assert after.columns == frame.columns
        kept[name] = (frame.collect(), after.collect())
        frame = spark.createDataFrame(kept[name][1], after.schema)
    before, after = kept["quality"]
    scored = {r["doc_id"]: r["kept"] for r in quality.quality(spark.createDataFrame(before), spark.read.parquet(f"{out}/labels.parquet")).collect()}
    assert {r["doc_id"] for r in after} == {d for d, k in scored.items() if k}
    assert sum((r["doc_id"] % 6 != 0) for r in after) >= 0.95 * sum(d % 6 != 0 for d, *_ in docs) and sum(r["doc_id"] % 6 == 0 for r in after) <= 5
    before, after = kept["near_dedup"]
    assert sorted(r["doc_id"] for r in after) == sorted({c for _, _, c in brute_groups([tuple(r) for r in before])})
    before, after = kept["decontamination"]
    bad = {d for d, _ in leaks([tuple(r) for r in before], [(i, t, "") for i, t in items])}
    assert bad and {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - bad
    before, after = kept["mixing"]
    times = {r["doc_id"]: r["times"] for r in mixing.mix(spark.createDataFrame(before)).collect()}
    assert sorted(r["doc_id"] for r in after) == sorted(d for d, n in times.items() for _ in range(n))
    before, after = kept["tokens"]
    assert sorted((tuple(r) for r in after), key=lambda r: r[1]) == brute_tokens([(r["doc_id"], r["text"], 0) for r in before])


def test_run_gives_the_same(spark, folder):
    out = folder[0]
    got = corpus_pipeline.run(spark, out).collect()
    starts = sorted((r["start"], r["n_tokens"]) for r in got)
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


CLASH = ["_sized", "log_weight", "evidence", "Key", "_digest", "digest", "root", "node", "mix_source", "mix_goal", "_copy", "row", "hash", "fp"]


def odd_tables(spark, out, docs, labels=True, items=True):
    names = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)
    spark.createDataFrame([(*d, *CLASH) for d in docs], names).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 0), (3, None, None)] if labels else [], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(None, None), (1, ""), (2, "a benchmark passage that is long enough to be looked for in segments")] if items else [], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return spark.read.parquet(f"{out}/documents.parquet")


ODD = [(1, "sea wind stone", "en", "a", 14), (2, None, None, None, None), (None, "sea wind stone", "en", None, 14), (None, "another text without an id", "en", "b", 0), (3, "", "en", "a", 0), (3, "x " * 60_000, "en", "a", 0), (3, "x " * 60_000, "en", "a", 0), (4, "same", "en", "a", 0), (4, "different", "en", "b", 0)]


def test_stages_take_odd_rows_and_clashing_columns(spark, tmp_path):
    frame = odd_tables(spark, str(tmp_path), ODD)
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, frame, str(tmp_path))
        rows = after.collect()
        if name != "tokens":
            assert after.columns == frame.columns and all([r[c] for c in CLASH] == CLASH for r in rows)
        if name == "near_dedup":  # the copies of "sea wind stone" and of the long text are one row each; null and empty text are copies
            assert sorted((repr(r["doc_id"]), (r["text"] or "")[:9]) for r in rows) == sorted([("1", "sea wind "), ("2", ""), ("None", "another t"), ("3", "x x x x x"), ("4", "same"), ("4", "different")])
        frame = spark.createDataFrame(rows, after.schema) if rows else after.limit(0)
    assert len(rows) >= 4


def test_stages_take_empty_tables(spark, tmp_path):
    frame = odd_tables(spark, str(tmp_path), [], labels=False, items=False)
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, frame, str(tmp_path))
        assert after.collect() == [] and (name == "tokens" or after.columns == frame.columns)


def test_nothing_is_rejected_without_labels_or_items(spark, tmp_path):
    frame = odd_tables(spark, str(tmp_path), ODD, labels=False, items=False)
    stages = dict(corpus_pipeline.STAGES)
    assert stages["quality"](spark, frame, str(tmp_path)).count() == stages["decontamination"](spark, frame, str(tmp_path)).count() == len(ODD)


@pytest.mark.skipif(not os.path.isdir(SF), reason="the standard tables are not here")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    from tests.test_oracles import compare

    compare(spark, queries.QUERIES[name], queries.ORACLE_SQL[name])


@pytest.mark.skipif(not os.path.isdir(SF), reason="the standard tables are not here")
@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0
