"""Near copies by the Jaccard similarity of their word shingles.

Fingerprints are SimHashes of the five-word shingles, and the pigeonhole blocks of :mod:`tidemark.llm.simhash` propose all
pairs that differ in at most 3 of their 64 bits. Texts with a similarity of at least 0.8 differ in some 10 bits, too many
for the blocks alone. So texts also meet in 20 keys of 5 minima each (at 0.8 all keys miss a pair in 4 of 10,000 cases),
and those of a key are linked where their fingerprints differ in at most ``BITS`` bits. All these links are only ever
handed on as spanning forests; their components are clusters, and every pair that may be a near copy lies within one.

The shingle sets (48-bit hashes) of a cluster come together once. Pairs within ``simhash.BITS`` bits, and pairs that share
a key and are within ``BITS`` bits, are settled by the sets, nearest fingerprints first, and a pair that settled links
connect already is left out: so no link is lost, whatever forest the keys took, and a family of n texts costs little more than n comparisons where they are alike. A
cluster of more than ``TILE_ROWS`` texts or ``TILE_BYTES`` is dealt to pairs of tiles, each a group of its own. Only
distinct texts take part: copies cost nothing.

Cases: null counts as empty, texts without words are copies of each other; texts with fewer words than a shingle have
their whole word sequence as the only shingle; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, first_rows, groups_of, hooked, join_keyed, pieces, stored, utf8_of, words_of
from tidemark.llm.components import components
from tidemark.llm.simhash import BITS as BLOCK_BITS
from tidemark.llm.simhash import forest_by_comparison
from tidemark.llm.simhash import links as block_links

SHINGLE, LEAST = 5, 0.8
#: Keys, minima in each, and bits in which the fingerprints of a proposed pair may differ (at 0.8: 10 on average, deviation 3).
KEYS, MINIMA, BITS = 20, 5, 20
#: Texts and bytes of shingle sets in one tile of a large cluster.
TILE_ROWS, TILE_BYTES = 2048, 16 << 20
#: Pairs of a cluster are settled in this order of differing bits, those of each step together.
STEPS = (6, 9, 12, 15, BITS)
#: Bytes of each shingle's hash that are kept for the sets: they are most of what this stage writes and shuffles.
KEPT_BYTES = 6
_RNG = np.random.default_rng(42)
_FACTOR, _SHIFT = (_RNG.integers(0, 1 << 63, KEYS * MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _STEP
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> Iterator[tuple[int, np.ndarray]]:
    """Hash of the word sequence and sorted distinct hashes of the shingles of each text."""
    words, per = words_of(texts)
    coded = words.dictionary_encode()
    data, off = utf8_of(coded.dictionary)
    raw = data.tobytes()
    own = np.array([xxhash.xxh64_intdigest(raw[a:b]) for a, b in itertools.pairwise(off.tolist())], np.uint64)
    flat = own[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else own
    for stop, n in zip(np.cumsum(per).tolist(), per.tolist(), strict=True):
        w = flat[stop - n : stop]
        size = min(shingle, n)
        total = np.zeros(max(1, n - size + 1), np.uint64)
        for k in range(size):
            total = total * _STEP + w[k : k + len(total)]
        yield xxhash.xxh64_intdigest(w.tobytes()), np.unique(_mixed(total + np.uint64(size)))


#: Work space of _minima; a new one for each text would cost more than the products.
_SPACE = np.empty((KEYS * MINIMA, 256), np.uint64)


def _minima(grams: np.ndarray) -> np.ndarray:
    out = np.full(len(_FACTOR), np.iinfo(np.uint64).max)
    for lo in range(0, len(grams), _SPACE.shape[1]):
        part = grams[lo : lo + _SPACE.shape[1]]
        space = _SPACE[:, : len(part)]
        np.multiply(part[None, :], _FACTOR[:, None], out=space)
        np.add(space, _SHIFT[:, None], out=space)
        np.minimum(out, space.min(axis=1), out=out)
    return out


def _fingerprint(grams: np.ndarray) -> int:
    bits = np.unpackbits(grams.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(grams), bitorder="little").view("<u8")[0])


def packed(grams: np.ndarray) -> np.ndarray:
    """The lower bytes of the hashes: of pairs of texts with 2,000 words each, about one in 30 million has two shingles that share 48 bits."""
    return np.ascontiguousarray(grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEPT_BYTES]).reshape(-1)


def unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // KEPT_BYTES, 8), np.uint8)
    out[:, :KEPT_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, KEPT_BYTES)
    return out.reshape(-1).view("<u8")


def _sketch(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = list(shingle_sets(batch.column("text"), shingle))
            node, sets = np.array([h for h, _ in found], np.uint64), [g for _, g in found]
            fp = np.array([_fingerprint(g) for g in sets], np.uint64)
            minima = np.stack([_minima(g) for g in sets]).reshape(-1, KEYS, MINIMA)
            key = np.broadcast_to(np.arange(KEYS, dtype=np.uint64), minima.shape[:2])
            for k in range(MINIMA):
                key = _mixed(key * _STEP + minima[:, :, k])
            ends = np.concatenate([[0], np.cumsum([len(g) for g in sets])])
            keys = pa.ListArray.from_arrays(pa.array((np.arange(len(sets) + 1) * KEYS).astype(np.int32)), pa.array(key.reshape(-1).view(np.int64)))
            grams = pieces(packed(np.concatenate(sets)), ends * KEPT_BYTES, pa.binary())
            yield pa.record_batch([batch.column("doc_id"), batch.column("digest"), pa.array(node.view(np.int64)), pa.array(fp.view(np.int64)), keys, grams], ["doc_id", "digest", "node", "fp", "keys", "grams"])

    return run


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every key the links of a spanning forest of its texts within ``BITS`` bits."""
    for group in groups_of(batches, ["key"]):
        if group.num_rows > 1:
            node = group.column("node").to_numpy()
            a, b = forest_by_comparison(group.column("fp").to_numpy().view(np.uint64), BITS)
            if len(a):
                yield pa.record_batch([pa.array(np.minimum(node[a], node[b])), pa.array(np.maximum(node[a], node[b]))], ["u", "v"])


def proposed_by_blocks(distinct: DataFrame) -> DataFrame:
    """u, v: links between nodes that connect all texts whose fingerprints differ in at most ``simhash.BITS`` bits."""
    prints = stored(distinct.groupBy("fp").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("texts")), "fingerprints")
    equal = join_keyed(distinct.select("fp", "node"), prints.filter("texts > 1"), "fp", "texts", distinct.count()).filter("node <> first")
    # Each fingerprint is a row here, but a link may name one many times: the ends that it has are counted first.
    ends = stored(block_links(prints.select("fp")).distinct(), "blocks")
    total = ends.count()
    for end, node in (("u", "a"), ("v", "b")):
        often = ends.groupBy(end).agg(F.count(F.lit(1)).alias("times"))
        named = often.join(prints.select(F.col("fp").alias(end), F.col("first").alias(node)).hint("merge"), end)
        ends = join_keyed(ends, named, end, "times", total)
    pairs = ends.select("a", "b").unionByName(equal.select(F.col("node").alias("a"), F.col("first").alias("b")))
    return pairs.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets, each distinct."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def settled(fp: np.ndarray, keys: np.ndarray, tile: np.ndarray, apart: bool, sets: list[np.ndarray], least: float) -> tuple[list[int], list[int]]:
    """Links of a spanning forest of the near copies in a group. ``apart``: only pairs of different tiles are looked at."""
    n, root = len(fp), np.arange(len(fp))
    u, v = [], []
    for low, high in itertools.pairwise((-1, *STEPS)):
        for at in range(0, n, 256):
            rows = np.arange(at, min(at + 256, n))
            bits = np.bitwise_count(fp[rows][:, None] ^ fp[None, :]).astype(np.int16)
            open_ = (bits > low) & (bits <= high) & (rows[:, None] < np.arange(n)[None, :]) & (root[rows][:, None] != root[None, :])
            if apart:
                open_ &= tile[rows][:, None] != tile[None, :]
            i, j = np.nonzero(open_)
            if not len(i):
                continue
            order = np.argsort(bits[i, j], kind="stable")
            i, j = i[order] + at, j[order]
            for part in range(0, len(i), 1 << 16):
                a, b = i[part : part + (1 << 16)], j[part : part + (1 << 16)]
                met = (root[a] != root[b]) & ((np.bitwise_count(fp[a] ^ fp[b]) <= BLOCK_BITS) | (keys[a] == keys[b]).any(axis=1))
                for x, y in zip(a[met].tolist(), b[met].tolist(), strict=True):
                    if root[x] != root[y] and similarity(sets[x], sets[y]) >= least:
                        u.append(x)
                        v.append(y)
                        root = hooked(root, np.array([x]), np.array([y]))
    return u, v


def _settle(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, ["root", "left", "right"]):
            if group.num_rows < 2:
                continue
            node, fp, tile = (group.column(c).to_numpy() for c in ("node", "fp", "tile"))
            keys = group.column("keys").flatten().to_numpy().reshape(-1, KEYS)
            sets = [unpacked(g.as_buffer()) for g in group.column("grams")]
            apart = group.column("left")[0].as_py() != group.column("right")[0].as_py()
            u, v = settled(fp.view(np.uint64), keys, tile, apart, sets, least)
            if u:
                yield pa.record_batch([pa.array(node[u]), pa.array(node[v])], ["u", "v"])

    return run


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = LEAST, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, digest (xxhash64 of the text), root (equal for all documents of a group)."""
    body = F.col(text).cast("string")
    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("digest"))
    sketches = slim.mapInArrow(_sketch(shingle), "doc_id bigint, digest bigint, node bigint, fp bigint, keys array<bigint>, grams binary")
    rows = stored(sketches.withColumn("row", F.monotonically_increasing_id()), "sketches")
    # One row per distinct text, and in ``row`` the one of its copies that stands for it.
    one = F.struct("row", "fp", "keys", F.octet_length("grams").alias("bytes"))
    distinct = stored(rows.groupBy("node").agg(F.min_by(one, "row").alias("one"), F.count(F.lit(1)).alias("copies")).select("node", "copies", "one.*"), "distinct")
    keyed = distinct.select(F.explode("keys").alias("key"), "fp", "node").repartition("key").sortWithinPartitions("key")
    pairs = stored(keyed.mapInArrow(_propose, "u bigint, v bigint").unionByName(proposed_by_blocks(distinct)).distinct(), "proposed")
    led = stored(components(pairs), "clusters")
    members = led.unionByName(led.select(F.col("root").alias("node"), "root").distinct())
    members = stored(distinct.select("node", "row", "bytes").join(members.hint("merge"), "node"), "members")
    # Large clusters are dealt to tiles: a text goes to the group of its tile with every tile. Small ones are one tile.
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("texts"), F.sum("bytes").alias("weight"))
    tiles = F.least("texts", F.greatest(F.ceil(F.col("texts") / TILE_ROWS), F.ceil(F.col("weight") / TILE_BYTES))).cast("int")
    dealt = join_keyed(members.drop("bytes"), sizes.select("root", "texts", tiles.alias("tiles")), "root", "texts", members.count())
    dealt = dealt.select("row", "node", "root", "tiles", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int").alias("tile"))
    # Rows are unique here, so this join has no hot keys; nothing is broadcast, since all of it grows with the input.
    sets = rows.select("row", "fp", "keys", "grams").join(dealt.hint("merge"), "row")
    sets = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    sets = sets.select("root", F.least("tile", "other").alias("left"), F.greatest("tile", "other").alias("right"), "tile", "node", "fp", "keys", "grams")
    sets = sets.repartition("root", "left", "right").sortWithinPartitions("root", "left", "right")
    links = stored(sets.mapInArrow(_settle(least), "u bigint, v bigint"), "links")
    copies = distinct.select("node", "copies")
    rooted = stored(copies.join(components(links).hint("merge"), "node"), "rooted")
    out = join_keyed(rows.select("doc_id", "digest", "node"), rooted, "node", "copies", rows.count(), "left")
    return out.select("doc_id", "digest", F.coalesce("root", "node").alias("root"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group, all columns: the one with the smallest id, null last; of equal rows a single one stays."""
    return first_rows(docs, near_groups(docs, doc_id, text), doc_id, text)
