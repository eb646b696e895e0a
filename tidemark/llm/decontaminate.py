"""Benchmark decontamination by the q-gram lemma.

Benchmark items are cut into segments of ``SEGMENT`` characters, one every ``STRIDE``, so that every excerpt of
SEGMENT + STRIDE - 1 characters holds a whole segment. A segment of m characters occurs with at most e edits only if at
least m + 1 - q (e + 1) of its q-grams occur on diagonals (place in the document minus place in the item) that lie within
e of each other. Documents are scanned once: rolling hashes of all q-grams are looked up in the index of benchmark
q-grams, hits are counted in overlapping diagonal bands, regions that reach the bound are kept, and a banded alignment
settles each of them. The index is a broadcast of checked size; a larger benchmark is taken in blocks of items, so no
item and no text is left out.

Texts are compared with A-Z lower-cased and runs of white space as one blank. Items below ``SHORTEST`` characters carry
too little to forgive edits: they must occur as a whole, without edits, and with no letter or digit right before or
behind them. Those below ``Q`` characters are found by hashes of their own length.

Cases: null text counts as empty; null or empty items match nothing; equal items are all reported; rows of the benchmark
with one id count as one item with several texts, those without id likewise; negative ids are ids like others; repeated
documents are each reported; an empty table on either side gives an empty result; other columns pass through
:func:`keep_clean`.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, stored, utf8_of
from tidemark.llm.quality import chunks_of
from tidemark.llm.subwords import is_alphanumeric

#: Length of a q-gram and of a segment, how far segments stand apart, share of edits allowed, shortest item with edits.
Q, SEGMENT, STRIDE, EDITS, SHORTEST = 8, 50, 10, 0.08, 40
#: Characters of benchmark text per block; the index takes some 60 bytes for each.
BLOCK_CHARS = 2_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_FILTER_BITS = 22
#: Texts are moved apart by more than a segment and its bands.
APART = 4 * SEGMENT


def normalise(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts as compared, offsets of the texts in them, and the place of each in its text."""
    data, off = utf8_of(texts)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    doc = np.searchsorted(lead, off)
    upper = (codes >= 65) & (codes <= 90)
    codes = codes + np.uint32(32) * upper
    blank = (codes == 32) | (codes >= 9) & (codes <= 13)
    codes[blank] = 32
    drop = np.zeros(len(codes), bool)
    drop[1:] = blank[1:] & blank[:-1]
    drop[doc[:-1][doc[:-1] < len(codes)]] = False
    at = np.flatnonzero(~drop)
    new = np.searchsorted(at, doc)
    return codes[at], new, at - np.repeat(doc[:-1], np.diff(new))


def qgram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """Polynomial hash of codes[i:i+q] for every i, put together from windows of 1, 2, 4, ... characters."""
    if len(codes) < q:
        return np.zeros(0, np.uint64)
    part, size = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93), 1
    out, have = None, 0
    while size <= q:
        if q & size:
            if out is None:
                out, have = part, size
            else:
                n = len(codes) - have - size + 1
                out, have = out[:n] * _pow(size) + part[have : have + n], have + size
        part, size = part[:-size] * _pow(size) + part[size:], size * 2
    return out ^ (out >> np.uint64(29))


def _pow(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def _slot(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * _BASE) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


@dataclass
class Index:
    """Segments of a block of items and the q-grams of the items."""

    ids: pa.Array  # distinct item ids, a null among them if there is one
    item: np.ndarray  # of each segment, its place in ids
    codes: list[np.ndarray]  # of each segment
    filter: np.ndarray  # hash slots in use
    grams: np.ndarray  # distinct hashes, sorted
    first: np.ndarray  # of each distinct hash, where its postings start
    text: np.ndarray  # postings: text and place in it
    place: np.ndarray
    segments: np.ndarray  # of each text, its first segment; one more at the end
    start: np.ndarray  # of each segment, its place in its text
    length: np.ndarray  # of each segment
    tiny: dict[int, tuple[np.ndarray, np.ndarray]]  # by length below Q: sorted hashes and the segments they stand for

    @property
    def edits(self) -> np.ndarray:
        return np.array([allowed(len(c)) for c in self.codes], np.int64)

    def ids_of(self, segments: np.ndarray) -> pa.Array:
        return self.ids.take(pa.array(self.item[segments]))


def allowed(m: int, rate: float = EDITS, q: int = Q) -> int:
    """Edits allowed in m characters: none below ``SHORTEST``, else the share, but never so many that the lemma's bound falls below one q-gram."""
    return 0 if m < SHORTEST else max(0, min(int(rate * m), m // q - 1))


def build_index(items: list[tuple[int | None, str | None]], q: int = Q, size: int = SEGMENT, stride: int = STRIDE) -> Index:
    names: dict[int | None, int] = {}
    owner, segments, start, bounds, hashes, small = [], [], [], [0], [], {}
    for item, text in items:
        codes, _, _ = normalise(pa.array([(text or "").strip()], pa.string()))
        if not len(codes):
            continue
        name = names.setdefault(item, len(names))
        last = max(0, len(codes) - size)
        for at in sorted({*range(0, last + 1, stride), last}):
            if len(codes) < q:
                small.setdefault(len(codes), []).append((qgram_hashes(codes, len(codes))[0], len(segments)))
            owner.append(name)
            segments.append(codes[at : at + size])
            start.append(at)
        bounds.append(len(segments))
        hashes.append(qgram_hashes(codes, q))
    flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    owner_text = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
    place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.zeros(0, np.int64)
    order = np.argsort(flat, kind="stable")
    grams, first = np.unique(flat[order], return_index=True)
    used = np.zeros(1 << _FILTER_BITS, bool)
    used[_slot(grams)] = True
    tiny = {n: tuple(np.array(c, t) for c, t in zip(zip(*sorted(found), strict=True), (np.uint64, np.int64), strict=True)) for n, found in small.items()}
    length = np.array([len(c) for c in segments], np.int64)
    return Index(pa.array(list(names), pa.int64()), np.array(owner, np.int64), segments, used, grams, np.append(first, len(flat)), owner_text[order], place[order], np.array(bounds), np.array(start, np.int64), length, tiny)


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ..., size[i] of them, behind one another."""
    ends = np.cumsum(size)
    return np.repeat(first - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


def _document(bounds: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(bounds, at, side="right") - 1


def _hits(codes: np.ndarray, bounds: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place in the texts, item text and place in it of every shared q-gram."""
    hashes = qgram_hashes(codes)
    at = np.flatnonzero(index.filter[_slot(hashes)])
    found = np.searchsorted(index.grams, hashes[at])
    right = index.grams[np.minimum(found, len(index.grams) - 1)] == hashes[at]
    at, found = at[right], found[right]
    inside = at + Q <= bounds[_document(bounds, at) + 1]
    at, found = at[inside], found[inside]
    size = index.first[found + 1] - index.first[found]
    post = _spread(index.first[found], size)
    return np.repeat(at, size), index.text[post], index.place[post]


def _reaching(key: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Which hits lie in a cell that reaches ``need`` together with a neighbouring cell."""
    cells, which, n = np.unique(key, return_inverse=True, return_counts=True)
    after = np.concatenate([np.where(cells[1:] == cells[:-1] + 1, n[1:], 0), [0]])
    before = np.concatenate([[0], np.where(cells[1:] == cells[:-1] + 1, n[:-1], 0)])
    return (n + np.maximum(after, before))[which] >= need


def candidates(codes: np.ndarray, bounds: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment, document and lower diagonal of every band that reaches the lemma's bound."""
    none = np.zeros(0, np.int64)
    if not len(index.grams) or len(codes) < Q:
        return none, none, none
    at, text, place = _hits(codes, bounds, index)
    edits = index.edits
    need = index.length + 1 - Q * (edits + 1)
    # Cheap looks first: enough hits of the item on neighbouring diagonals, and there in neighbouring stretches. The
    # bound of an item's segments is least for the shortest, and all but an item's only one are equally long.
    least = need[index.segments[:-1]]
    for wide in (SEGMENT, 256):
        if not len(at):
            return none, none, none
        away = at - place + _document(bounds, at) * APART if wide == SEGMENT else at
        span = (len(codes) + (len(bounds) + 4) * APART) // wide + 8
        some = _reaching(text * span + away // wide + 2, least[text])
        at, text, place = at[some], text[some], place[some]
    if not len(at):
        return none, none, none
    # Every hit counts for the segments that hold its q-gram.
    first, last = index.segments[text], index.segments[text + 1] - 1
    lo = np.maximum(first, first + -(-(place + Q - SEGMENT) // STRIDE))
    hi = np.minimum(last, first + place // STRIDE)
    lo, hi = np.minimum(lo, last), np.maximum(hi, last)  # the last segment stands off the grid
    size = hi - lo + 1
    seg = _spread(lo, size)
    at, place = np.repeat(at, size), np.repeat(place, size)
    place = place - index.start[seg]
    held = (place >= 0) & (place + Q <= index.length[seg])
    at, seg, place = at[held], seg[held], place[held]
    # Bands of width 2 e, one every e: what differs by at most e lies in one of them whole. Texts are moved apart, so
    # that no band reaches into two of them.
    doc = _document(bounds, at)
    step = np.maximum(edits[seg], 1)
    band = (at + doc * APART - place) // step + APART
    span = len(codes) + (len(bounds) + 2) * APART
    key = np.concatenate([seg * span + band, seg * span + band - 1])
    cells, which, n = np.unique(key, return_inverse=True, return_counts=True)
    full = n >= need[cells // span]
    owner = np.zeros(len(cells), np.int64)
    owner[which] = np.concatenate([doc, doc])
    cells, owner = cells[full], owner[full]
    segment = cells // span
    return segment, owner, (cells % span - APART) * np.maximum(edits[segment], 1) - owner * APART


def banded_distance(pattern: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each pattern (rows of equal length m) against its text, and the diagonal it ends on.

    ``text`` has m + W - 1 columns: the alignment may start and end on any of the W diagonals.
    """
    c, m = pattern.shape
    width = text.shape[1] - m + 1
    steps = np.arange(width)
    cost = np.zeros((c, width), np.int64)
    for i in range(m):
        sub = cost + (text[:, i : i + width] != pattern[:, i : i + 1])
        skip = np.concatenate([cost[:, 1:] + 1, np.full((c, 1), m + 1)], axis=1)
        cost = np.minimum.accumulate(np.minimum(sub, skip) - steps, axis=1) + steps
    return cost.min(axis=1), cost.argmin(axis=1)


def matches(texts: pa.Array, index: Index) -> dict[str, np.ndarray]:
    """Every verified occurrence of a segment: doc (row), segment, edits, start and end (characters of the text)."""
    codes, bounds, places = normalise(texts)
    seg, doc, low = candidates(codes, bounds, index)
    out = {k: [] for k in ("doc", "segment", "edits", "start", "end")}
    length = index.length[seg]
    for m in np.unique(length):
        e = allowed(int(m))
        width = 2 * max(e, 1) + 2 * e + 1
        rows = np.flatnonzero(length == m)
        for part in range(0, len(rows), 2048):
            r = rows[part : part + 2048]
            begin = low[r] - e
            where = begin[:, None] + np.arange(m + width - 1)
            lo, hi = bounds[doc[r]][:, None], bounds[doc[r] + 1][:, None]
            window = np.where((where >= lo) & (where < hi), codes[np.clip(where, 0, len(codes) - 1)].astype(np.int64), -1)
            least, at = banded_distance(np.stack([index.codes[s] for s in seg[r]]).astype(np.int64), window)
            ok = least <= e
            if m < SHORTEST:
                ok &= _stands_alone(codes, bounds, doc[r], begin + at, m)
            start = np.clip(begin + at, bounds[doc[r]], bounds[doc[r] + 1] - 1)
            end = np.clip(begin + at + m - 1, bounds[doc[r]], bounds[doc[r] + 1] - 1)
            for name, value in (("doc", doc[r]), ("segment", seg[r]), ("edits", least), ("start", places[start]), ("end", places[end] + 1)):
                out[name].append(value[ok])
    for m, (hashes, owners) in index.tiny.items():
        here = qgram_hashes(codes, m)
        at = np.flatnonzero(np.isin(here, hashes))
        doc = _document(bounds, at)
        at = at[(at + m <= bounds[doc + 1]) & _stands_alone(codes, bounds, doc, at, m)]
        lo, hi = np.searchsorted(hashes, here[at], side="left"), np.searchsorted(hashes, here[at], side="right")
        seg, at = owners[_spread(lo, hi - lo)], np.repeat(at, hi - lo)
        for name, value in (("doc", _document(bounds, at)), ("segment", seg), ("edits", np.zeros(len(at), np.int64)), ("start", places[at]), ("end", places[at + m - 1] + 1)):
            out[name].append(value)
    return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}


def _stands_alone(codes: np.ndarray, bounds: np.ndarray, doc: np.ndarray, at: np.ndarray, m: int) -> np.ndarray:
    """Whether no letter or digit of the document stands right before or behind the m characters."""
    before = (at > bounds[doc]) & is_alphanumeric(codes[np.maximum(at - 1, 0)])
    behind = (at + m < bounds[doc + 1]) & is_alphanumeric(codes[np.minimum(at + m, len(codes) - 1)])
    return ~before & ~behind


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> list[Callable[[], Index]]:
    """What builds the index of each block of items, of bounded size; one index is held at a time."""
    items = benchmark.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text).cast("string").alias("text")).filter(F.col("text").isNotNull())
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = math.ceil(total / BLOCK_CHARS)

    def block(k: int) -> Index:
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        return build_index([(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()])

    return [lambda k=k: block(k) for k in range(n)]


_FOUND = "row bigint, doc_id bigint, item_id bigint, segments bigint, edits bigint, start bigint, end bigint"


def _leaks(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in chunks(batches):
            m = matches(batch.column("text"), index)
            if not len(m["doc"]):
                continue
            pair, which = np.unique(np.stack([m["doc"], index.item[m["segment"]]], axis=1), axis=0, return_inverse=True)
            which = which.reshape(-1)
            least, start, end = (np.full(len(pair), 1 << 40), np.full(len(pair), 1 << 40), np.zeros(len(pair), np.int64))
            np.minimum.at(least, which, m["edits"])
            np.minimum.at(start, which, m["start"])
            np.maximum.at(end, which, m["end"])
            seen = np.unique(np.stack([which, m["segment"]], axis=1), axis=0)[:, 0]
            doc = pa.array(pair[:, 0])
            columns = [batch.column("row").take(doc), batch.column("doc_id").take(doc), index.ids.take(pa.array(pair[:, 1]))]
            yield pa.record_batch([*columns, *map(pa.array, (np.bincount(seen, minlength=len(pair)), least, start, end))], ["row", "doc_id", "item_id", "segments", "edits", "start", "end"])

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, segments (of the item that occur), edits (of the best), start, end: one row per document row and item."""
    spark = docs.sparkSession
    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    blocks = _blocks(benchmark, item_id, item_text)
    out = spark.createDataFrame([], _FOUND)
    if len(blocks) > 1:
        slim = stored(slim, "numbered")  # rows keep their number over all blocks
    for block in blocks:
        out = out.unionByName(slim.mapInArrow(_leaks(spark.sparkContext.broadcast(block())), _FOUND))
    if len(blocks) > 1:  # the texts of one id may lie in several blocks
        out = out.groupBy("row", "item_id").agg(F.first("doc_id").alias("doc_id"), F.sum("segments").alias("segments"), F.min("edits").alias("edits"), F.min("start").alias("start"), F.max("end").alias("end"))
    return out.select("doc_id", "item_id", "segments", "edits", "start", "end")


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents in which no benchmark segment occurs, all columns, without a shuffle."""
    for block in _blocks(benchmark, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block())

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in chunks_of(batches, text):
                m = matches(batch.column(batch.schema.get_field_index(text)).fill_null(""), shared.value)
                clean = np.ones(batch.num_rows, bool)
                clean[m["doc"]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
