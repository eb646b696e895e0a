"""Subword ids, Elias-Fano structures and shard files: exact round trips."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import token_files
from tidemark.llm.elias_fano import EliasFano
from tidemark.llm.subwords import SubwordEncoder

encoder = SubwordEncoder(token_files.default_tokenizer())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab's'td  relv'm\n\t\r 1²9é中,.!-ßñ🙂  ́<|endoftext|>")), max_size=40), max_size=6))
def test_ids_equal_the_library(texts):
    texts = texts + ["x<|endoftext|>y", ""]
    ids, sizes = encoder.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(sizes)
    for t, e, n in zip(texts, ends, sizes, strict=True):
        assert ids[e - n : e].tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids


def test_the_cache_may_start_anew(monkeypatch):
    import tidemark.llm.subwords as s

    monkeypatch.setattr(s, "CACHE_PIECES", 3)
    small = SubwordEncoder(token_files.default_tokenizer())
    for t in ("one two three four", "five six", "one two seven"):
        assert small.encode(pa.array([t]))[0].tolist() == small.tokenizer.encode(t, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=700), st.integers(0, 1 << 45))
def test_elias_fano(steps, scale):
    values = np.cumsum(np.array(steps, np.uint64) * np.uint64(scale % 1000 + 1), dtype=np.uint64) + np.uint64(scale)
    ef = EliasFano.of(values)
    back, used = EliasFano.from_bytes(ef.to_bytes() + b"rest")
    assert used == len(ef.to_bytes()) and back.all().tolist() == values.tolist()
    for i in {0, len(values) // 2, len(values) - 1} if len(values) else ():
        assert back.select(i) == int(values[i])


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    assert len(EliasFano.of(values).to_bytes()) * 8 / len(values) < 2 + np.log2(values[-1] / len(values)) + 0.6
    with pytest.raises(ValueError):
        EliasFano.of(np.array([2, 1]))


def rows():
    return [(5, "five words of plain text", 1), (2, None, 2), (9, "", 3), (None, "no id", 4), (7, "again", 5), (7, "again", 6), (7, "Again", 7), (3, "naïve 中文 " * 4000, 8)]


def brute(data):
    out, at = [], 0
    for d, t, _ in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = np.array(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        out.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_shards_read_back(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, start long")
    got = sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.token_files(df).collect()), key=lambda r: r[1])
    assert got == brute(rows())


def test_many_shards_and_random_access(spark, monkeypatch, tmp_path):
    df = spark.createDataFrame([(i, f"text number {i} " * (i % 5), 0) for i in range(500)], "doc_id long, text string, start long")
    manifest = token_files.write_shards(df.repartition(3), token_files.default_tokenizer(), uri=f"file://{tmp_path}/shards")
    assert sum(m["n_docs"] for m in manifest) == 500 and [m["start"] for m in manifest] == np.cumsum([0] + [m["n_ids"] for m in manifest[:-1]]).tolist()
    seen = []
    for m in manifest:
        with open(m["name"], "rb") as f:
            shard = token_files.Shard(f.read())
        for i, d in enumerate(shard.doc_ids()):
            assert shard.document(i).tolist() == encoder.tokenizer.encode(f"text number {d} " * (d % 5), add_special_tokens=False).ids + [0]
            seen.append(d)
    assert seen == list(range(500))


def test_a_torn_file_is_noticed():
    data = token_files.shard_bytes(np.array([1, 0]), np.array([2]), np.array([4]), 0, 2)
    assert token_files.Shard(data).document(0).tolist() == [1, 0]
    with pytest.raises(ValueError):
        token_files.Shard(data[:-1])


def test_no_documents(spark):
    assert token_files.token_files(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_slices_of_elias_fano_match_the_whole():
    rng = np.random.default_rng(7)
    for n, u in ((1, 1), (5, 3), (1000, 50), (3000, 10**7)):
        values = np.sort(rng.integers(0, u, n))
        ef = EliasFano.of(values)
        for a, b in [(0, n), (0, 0), *(sorted(rng.integers(0, n + 1, 2).tolist()) for _ in range(20))]:
            assert ef.slice(a, b).tolist() == values[a:b].tolist()


def test_manifest_is_beside_the_shards_and_blocks_do_not_matter(spark, monkeypatch):
    rows = [(None if i % 9 == 0 else i // 2, f"text {i} " * (i % 5), "x") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string")
    manifest = token_files.write_shards(df, token_files.default_tokenizer())
    assert token_files.read_manifest(manifest[0]["uri"]) == manifest
    one = sorted(map(tuple, token_files.read_shards(spark, manifest).collect()), key=repr)
    assert len(one) == 300
    store, _ = token_files.fs.FileSystem.from_uri(manifest[0]["uri"])
    shard = token_files.Shard(store.open_input_stream(manifest[0]["name"]).read())
    assert sum((shard.doc_ids(a, min(a + 7, len(shard))) for a in range(0, len(shard), 7)), []) == shard.doc_ids()
