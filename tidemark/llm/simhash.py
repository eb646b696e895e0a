"""SimHash near-duplicates by pigeonhole blocks.

A 64-bit fingerprint is cut into 6 blocks. Two fingerprints that differ in at most 3 bits agree on at least 3 whole
blocks, so they share one of the 20 keys made of 3 blocks each (31 to 33 bits: at random almost nothing else shares
them). Only distinct fingerprints take part: copies cost nothing. The fingerprints of a key are compared by Hamming
distance, and a spanning forest of the links is handed on, never all pairs. A key with many fingerprints is searched
by flipping up to 3 of its free bits, at a cost in proportion to its fingerprints, so no cap is needed.

Cases: null counts as empty, texts without words have fingerprint 0 and link like any other; texts with fewer words than
a shingle hash their whole word sequence; repeated rows and ids are kept; a null ``doc_id`` takes part in links but is
never a component's id unless nothing else is there; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, first_rows, join_keyed, stored, utf8_of, words_of
from tidemark.llm.components import components

SHINGLE, BITS, SEED = 3, 3, 42
#: Widths of the blocks; with d bits allowed, 2 d blocks, any d of which make a key.
WIDTHS = (11, 11, 11, 11, 10, 10)
#: Up to so many fingerprints of a key are compared with each other; beyond it, flipping free bits is cheaper.
DIRECT = 4096


def fingerprint_of(words: list[bytes], shingle: int = SHINGLE) -> int:
    """Bit k is set if it is set in over half of the XXH64 of the shingles."""
    if not words:
        return 0
    grams = [b" ".join(g) for g in zip(*(words[i:] for i in range(shingle)), strict=False)] if len(words) >= shingle else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(g, SEED) for g in grams), np.uint64, len(grams))
    total = np.zeros(64, np.int64)
    for part in range(0, len(h), 1 << 15):  # bounded memory for very long texts
        bits = np.unpackbits(h[part : part + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(h), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            words, per = words_of(batch.column("text"))
            data, off = utf8_of(words)
            raw, off = data.tobytes(), off.tolist()
            flat = [raw[a:b] for a, b in itertools.pairwise(off)]
            ends = np.cumsum(per)
            found = np.array([fingerprint_of(flat[e - n : e], shingle) for e, n in zip(ends.tolist(), per.tolist(), strict=True)], np.uint64)
            yield pa.record_batch([batch.column("doc_id"), batch.column("digest"), pa.array(found.view(np.int64))], ["doc_id", "digest", "fp"])

    return run


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, digest (xxhash64 of the text) and fp (the fingerprint's 64 bits as a signed long), written once."""
    body = F.col(text).cast("string")
    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("digest"))
    return stored(slim.mapInArrow(_fingerprints(shingle), "doc_id bigint, digest bigint, fp bigint"), "fingerprints")


def block_masks(widths: tuple[int, ...] = WIDTHS, bits: int = BITS) -> list[int]:
    """One 64-bit mask per key: the blocks that must agree."""
    if sum(widths) != 64 or len(widths) <= bits:
        raise ValueError("the blocks must have 64 bits in all and be more than the bits allowed to differ")
    at, blocks = 0, []
    for w in widths:
        blocks.append(((1 << w) - 1) << at)
        at += w
    return [sum(c) for c in itertools.combinations(blocks, len(widths) - bits)]


def forest(fps: np.ndarray, mask: int, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Edges (two index arrays) that connect what links of at most ``bits`` differing bits connect. ``fps``: distinct, equal under ``mask``."""
    return forest_by_comparison(fps, bits) if len(fps) <= DIRECT else _forest_by_flips(fps, mask, bits)


def forest_by_comparison(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Breadth-first search; each fingerprint is compared with those not reached yet, so a dense group is cheap."""
    rest, a_out, b_out = np.arange(len(fps)), [], []
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            near = np.bitwise_count(fps[rest] ^ fps[i]) <= bits
            if near.any():
                found = rest[near].tolist()
                rest = rest[~near]
                queue += found
                a_out += [i] * len(found)
                b_out += found
    return np.array(a_out, np.int64), np.array(b_out, np.int64)


def _forest_by_flips(fps: np.ndarray, mask: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Looks up each fingerprint with up to ``bits`` of its free bits flipped: the cost is in proportion to their number."""
    n, order = len(fps), np.argsort(fps)
    ranked, root = fps[order], np.arange(n)
    a_out, b_out = [], []
    free = [1 << k for k in range(64) if not mask >> k & 1]
    for size in range(1, bits + 1):
        for flip in itertools.combinations(free, size):
            other = ranked ^ np.uint64(sum(flip))
            at = np.minimum(np.searchsorted(ranked, other), n - 1)
            hit = np.flatnonzero((ranked[at] == other) & (ranked < other) & (root != root[at]))
            while len(hit):  # hook the larger root to the smaller one, one link per root at a time
                high, low = np.maximum(root[hit], root[at[hit]]), np.minimum(root[hit], root[at[hit]])
                _, once = np.unique(high, return_index=True)
                a_out.append(order[hit[once]])
                b_out.append(order[at[hit[once]]])
                root[high[once]] = low[once]
                while not np.array_equal(root, jumped := root[root]):
                    root = jumped
                hit = hit[root[hit] != root[at[hit]]]
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return join(a_out), join(b_out)


def _links(bits: int, masks: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (k, key); a key's rows may lie in several batches."""
        tail_k, tail_key, tail_fp = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                if not batch.num_rows:
                    continue
                k = np.concatenate([tail_k, batch.column("k").to_numpy()])
                key = np.concatenate([tail_key, batch.column("key").to_numpy()])
                fp = np.concatenate([tail_fp, batch.column("fp").to_numpy()])
            else:
                k, key, fp = tail_k, tail_key, tail_fp
            if not len(k):
                continue
            new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (key[1:] != key[:-1])]))
            ends = np.append(new[1:], len(k))
            if batch is not None:  # the last key may go on
                tail_k, tail_key, tail_fp = k[new[-1] :], key[new[-1] :], fp[new[-1] :]
                new, ends = new[:-1], ends[:-1]
            several = ends - new > 1
            us, vs = [], []
            for s, e in zip(new[several].tolist(), ends[several].tolist(), strict=True):
                group = fp[s:e].view(np.uint64)
                a, b = forest(group, masks[int(k[s])], bits)
                us.append(fp[s:e][a])
                vs.append(fp[s:e][b])
            if us:
                yield pa.record_batch([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    return run


def links(distinct: DataFrame, bits: int = BITS, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """u, v: links between distinct fingerprints (column fp) that connect whatever lies within ``bits``."""
    masks = block_masks(widths, bits)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])).alias("b")
    blocks = distinct.select("fp", keys).select("b.k", "b.key", "fp").repartition("k", "key").sortWithinPartitions("k", "key")
    return blocks.mapInArrow(_links(bits, masks), "u bigint, v bigint")


def _rooted(prints: DataFrame, bits: int, widths: tuple[int, ...]) -> DataFrame:
    """fp, root and component_id of every fingerprint, and in ``copies`` how many rows have it."""
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")), "distinct")
    rooted = components(links(distinct, bits, widths))
    label = distinct.join(rooted, distinct["fp"] == rooted["node"], "left").select("fp", "first", "copies", F.coalesce("root", "fp").alias("root"))
    label = stored(label, "roots")
    least = label.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("members"))
    return join_keyed(label, least, "root", "members", label.count()).select("fp", "root", "component_id", "copies")


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    prints = fingerprints(docs, doc_id, text, shingle)
    label = _rooted(prints, bits, widths)
    out = join_keyed(prints, stored(label, "labels"), "fp", "copies", prints.count())
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group, all columns: the one with the smallest id, null last; of equal rows a single one stays."""
    prints = fingerprints(docs, doc_id, text)
    label = _rooted(prints, BITS, WIDTHS)
    groups = join_keyed(prints, stored(label, "labels"), "fp", "copies", prints.count()).select("doc_id", "digest", "root")
    return first_rows(docs, groups, doc_id, text)
