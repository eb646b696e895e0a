"""Token ids in binary shards with Elias-Fano document boundaries.

Shards follow each other in ascending ``doc_id``. A shard file is::

    8 bytes magic | u32 width of an id in bytes | u64 number of ids | u64 rows with a null doc_id (they come first)
    ids, little-endian, 2 or 4 bytes each: the concatenated documents, each closed by the end id
    Elias-Fano: end offset of every document    (select gives any document's place without a 64-bit table)
    Elias-Fano: doc_id minus the shard's smallest doc_id, which stands before it as an i64
    u64 place of the first Elias-Fano structure | 8 bytes magic

A shard is written under a name of its own and then moved to its final name, so a task that is run again after a lost
executor replaces the same bytes. Ids are encoded by :mod:`tidemark.llm.subwords`.

Cases: null text counts as empty (just the end id); null ids come first; repeated ids and rows are all written, ordered
by text; an empty table gives no shards and an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, shared_dir
from tidemark.llm.elias_fano import EliasFano
from tidemark.llm.subwords import encoder

MAGIC, END = b"TDMKTOK1", 0
_HEAD = struct.Struct("<8sIQQ")
#: A worker hands a shard on when it holds so many ids, so that memory stays bounded whatever the partition.
SHARD_IDS = 16_000_000
#: Documents whose boundaries are decoded at once when a shard is read.
BLOCK_DOCS = 4096
_RESULT = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def shard_bytes(ids: np.ndarray, sizes: np.ndarray, doc_ids: np.ndarray, nulls: int, width: int) -> bytes:
    """One shard file. ``doc_ids`` in ascending order, the ``nulls`` first rows without one (their value is ignored)."""
    body = ids.astype(f"<u{width}").tobytes()
    known = doc_ids[nulls:]
    least = int(known[0]) if len(known) else 0
    at = _HEAD.size + len(body)
    ef = EliasFano.of(np.cumsum(sizes)).to_bytes() + struct.pack("<q", least) + EliasFano.of((known - least).astype(np.uint64)).to_bytes()
    return _HEAD.pack(MAGIC, width, len(ids), nulls) + body + ef + struct.pack("<Q", at) + MAGIC


class Shard:
    """Random access to the documents of a shard file's bytes."""

    def __init__(self, data: bytes):
        magic, self.width, self.n_ids, self.nulls = _HEAD.unpack_from(data)
        if magic != MAGIC or data[-8:] != MAGIC:
            raise ValueError("not a whole shard file")
        (at,) = struct.unpack_from("<Q", data, len(data) - 16)
        self.ids = np.frombuffer(data, f"<u{self.width}", self.n_ids, _HEAD.size)
        view = memoryview(data)[at:]
        self.ends, used = EliasFano.from_bytes(view)
        (self.least,) = struct.unpack_from("<q", view, used)
        self.names, _ = EliasFano.from_bytes(view[used + 8 :])

    def __len__(self) -> int:
        return len(self.ends)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]

    def doc_ids(self, start: int = 0, stop: int | None = None) -> list[int | None]:
        stop = len(self) if stop is None else stop
        none, first = max(0, min(self.nulls, stop) - start), max(0, start - self.nulls)
        return [None] * none + (self.names.slice(first, max(first, stop - self.nulls)).astype(np.int64) + self.least).tolist()


def _write(uri: str, path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(uri)
        code, part, serial = encoder(path), TaskContext.get().partitionId(), 0
        width = 2 if code.tokenizer.get_vocab_size() <= 1 << 16 else 4
        held_ids, held_sizes, held_names, held_null, held = [], [], [], [], 0
        out = []

        def flush() -> None:
            nonlocal serial, held
            if not held_sizes:
                return
            sizes, null = np.concatenate(held_sizes), np.concatenate(held_null)
            data = shard_bytes(np.concatenate(held_ids), sizes, np.concatenate(held_names), int(null.sum()), width)
            name, own = f"{base}/shard-{part:06d}-{serial:05d}.bin", f"{base}/.{uuid.uuid4().hex}"
            with store.open_output_stream(own) as f:
                f.write(data)
            store.move(own, name)
            out.append((part, serial, name, int(sizes.sum()), len(sizes)))
            serial += 1
            held = 0
            for kept in (held_ids, held_sizes, held_names, held_null):
                kept.clear()

        for batch in chunks(batches, limit=3 << 20):
            ids, sizes = code.encode(batch.column("text"))
            ends = np.cumsum(sizes)
            held_ids.append(np.insert(ids.astype(f"u{width}"), ends, end))
            held_sizes.append(sizes + 1)
            held_names.append(batch.column("doc_id").fill_null(0).to_numpy())
            held_null.append(batch.column("doc_id").is_null().to_numpy(zero_copy_only=False))
            held += len(ids) + len(sizes)
            if held >= SHARD_IDS:
                flush()
        flush()
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(("part", "serial", "name", "n_ids", "n_docs"), r, strict=True)) for r in out], schema=pa.schema([("part", pa.int32()), ("serial", pa.int32()), ("name", pa.string()), ("n_ids", pa.int64()), ("n_docs", pa.int64())]))

    return run


def write_shards(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", end: int = END, uri: str | None = None) -> list[dict]:
    """Write the shards and return the manifest: one entry per shard, with the number of ids before it."""
    spark = docs.sparkSession
    uri = uri or shared_dir(spark, "tokens")
    store, base = fs.FileSystem.from_uri(uri)
    store.create_dir(base)
    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ordered = slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(_write(uri, tokenizer_path, end), "part int, serial int, name string, n_ids bigint, n_docs bigint").collect()
    at, manifest = 0, []
    for r in sorted(rows, key=lambda r: (r["part"], r["serial"])):
        manifest.append({"name": r["name"], "start": at, "n_ids": r["n_ids"], "n_docs": r["n_docs"], "uri": uri})
        at += r["n_ids"]
    with store.open_output_stream(f"{base}/manifest.json") as f:
        f.write(json.dumps([{k: v for k, v in m.items() if k != "uri"} for m in manifest]).encode())
    return manifest


def read_manifest(uri: str) -> list[dict]:
    """The manifest that :func:`write_shards` left beside its shards."""
    store, base = fs.FileSystem.from_uri(uri)
    with store.open_input_stream(f"{base}/manifest.json") as f:
        return [m | {"uri": uri} for m in json.loads(f.read())]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for entry in batch.to_pylist():
            store, _ = fs.FileSystem.from_uri(entry["uri"])
            with store.open_input_stream(entry["name"]) as f:
                shard = Shard(f.read())
            if len(shard) != entry["n_docs"] or shard.n_ids != entry["n_ids"]:
                raise ValueError(f"{entry['name']} does not agree with the manifest")
            for lo in range(0, len(shard), BLOCK_DOCS):
                hi = min(lo + BLOCK_DOCS, len(shard))
                ends = shard.ends.slice(lo, hi).astype(np.int64)
                starts = np.concatenate([[shard.ends.select(lo - 1) if lo else 0], ends[:-1]])
                crc = [zlib.crc32(shard.ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.record_batch([pa.array(shard.doc_ids(lo, hi), pa.int64()), pa.array(starts + entry["start"]), pa.array(ends - starts), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_shards(spark, manifest: list[dict]) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32. One task per shard."""
    schema = "name string, start bigint, n_ids bigint, n_docs bigint, uri string"
    if not manifest:
        return spark.createDataFrame([], _RESULT)
    shards = spark.createDataFrame([tuple(m[k] for k in ("name", "start", "n_ids", "n_docs", "uri")) for m in manifest], schema)
    return shards.repartition(len(manifest)).mapInArrow(_read, _RESULT)


def token_files(docs: DataFrame, tokenizer_path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents as shards and return what reading the shards back gives."""
    return read_shards(docs.sparkSession, write_shards(docs, tokenizer_path or default_tokenizer(), doc_id, text))


@functools.cache
def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
