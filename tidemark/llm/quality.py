"""Quality by importance resampling.

Two generative models of hashed token n-grams are counted: one of the raw corpus (every document) and one of the target
(a bounded sample of labelled good documents). A document's log importance weight is the sum over its n-grams of
log target minus log raw. Gumbel noise made from a hash of the id is added, and the k largest are kept: sampling k
documents without replacement in proportion to their weights. k is no constant: it is the number of documents, over
the whole corpus, whose weight lies above the threshold that separates the labelled sample best.

A few words make a document toxic, and hundreds of others drown them in that sum. So a second pair of models counts, in
how many of the labelled toxic and in how many of the other labelled documents each n-gram occurs; the sum over a
document's distinct n-grams that are ``TELLING`` times likelier in toxic ones is its evidence. Documents above a limit
have weight zero: they are never drawn.

The models are fitted to one half of the labelled sample, limit and threshold are set on the other.

The top k is found without sorting: histograms of the keys narrow down the k-th key, then a filter does the rest.

Tokens are runs of letters, digits, underscores and non-ASCII bytes, or runs of other visible characters, A-Z
lower-cased; n-grams are tokens and pairs of neighbours, where all pairs of a token with itself are one n-gram.

Cases: null text counts as empty and has weight 0 and no evidence; documents without a label only count as raw; of
several labels for an id the worst holds; rows that tie on key and id are kept or dropped together; without any usable
label everything is kept; an empty table gives an empty result; other columns pass through :func:`keep_good` untouched,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import _TO_LOWER, CHUNK_BYTES, chunks, fresh, pieces, stored, utf8_of

#: Hash buckets of the n-gram models; additive smoothing per bucket; labelled rows used at most; seed of the noise.
BUCKETS, SMOOTH, FIT_ROWS, SEED = 1 << 16, 1.0, 50_000, 7
#: Buckets of the toxic models; how much likelier (log) an n-gram must be to tell; share of other documents that the limit may cost.
TOXIC_BUCKETS, TELLING, LOSS = 1 << 18, 1.5, 0.005
#: Bytes of text at once; n-grams take some 50 times that while they are counted.
PART_BYTES = 1 << 20
#: Bins per histogram of keys, and rows of the boundary bin that may be looked at on the driver.
BINS, FEW = 4096, 10_000

_CLASS = np.ones(256, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
_CLASS[[*range(0x30, 0x3A), *range(0x41, 0x5B), 0x5F, *range(0x61, 0x7B), *range(0x80, 0x100)]] = 2
_K1, _K2, _SAME = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def ngram_buckets(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all n-grams, and the index of the text of each."""
    data, off = utf8_of(texts)
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _CLASS[data]
    head = np.zeros(n, bool)
    head[off[:-1][off[:-1] < n]] = True
    edge = np.ones(n, bool)
    edge[1:] = kind[1:] != kind[:-1]
    at = np.flatnonzero((edge | head) & (kind > 0))
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    visible = np.flatnonzero(kind > 0)
    coded = pieces(_TO_LOWER[data[visible]], np.append(np.searchsorted(visible, at), len(visible)), pa.binary()).dictionary_encode()
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((digest(t) for t in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    token = hashes[coded.indices.to_numpy(zero_copy_only=False)]
    doc = np.searchsorted(off, at, side="right") - 1
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    a, b = token[pair], token[pair + 1]
    both = np.where(a == b, _SAME, (a * _K1) ^ (b * _K2))
    mixed = np.concatenate([token, both]) * _K1
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64), np.concatenate([doc, doc[pair]])


def distinct_grams(texts: pa.Array, buckets: int = TOXIC_BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`ngram_buckets`, but each bucket once per text."""
    bucket, doc = ngram_buckets(texts, buckets)
    key = np.unique(doc * buckets + bucket)
    return key % buckets, key // buckets


def _count(buckets: int, toxic_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        toxic, other = np.zeros(toxic_buckets, np.int64), np.zeros(toxic_buckets, np.int64)
        for batch in chunks(batches, limit=PART_BYTES):
            bucket, doc = ngram_buckets(batch.column("text"), buckets)
            target = batch.column("good").fill_null(False).to_numpy(zero_copy_only=False)
            raw += np.bincount(bucket, minlength=buckets)
            good += np.bincount(bucket[target[doc]], minlength=buckets)
            known = batch.filter(batch.column("toxic").is_valid())
            if known.num_rows:
                bucket, doc = distinct_grams(known.column("text"), toxic_buckets)
                bad = known.column("toxic").to_numpy(zero_copy_only=False)[doc]
                toxic += np.bincount(bucket[bad], minlength=toxic_buckets)
                other += np.bincount(bucket[~bad], minlength=toxic_buckets)
        for first, a, b in ((0, raw, good), (buckets, toxic, other)):
            at = np.flatnonzero(a + b)
            yield pa.record_batch([pa.array(first + at), pa.array(a[at]), pa.array(b[at])], ["bucket", "a", "b"])

    return run


def labelled_sample(labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """At most ``rows`` labelled ids, chosen by a hash of the id: label_id, good (quality 1 and not toxic), toxic, fits (the half that models are fitted to)."""
    worst = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("label_id")).agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    usable = worst.filter(F.col("quality").isNotNull()).orderBy(F.xxhash64("label_id"), "label_id").limit(rows)
    return stored(usable.select("label_id", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"), (F.col("toxic") == 1).alias("toxic"), (F.pmod(F.xxhash64("label_id", F.lit(1)), F.lit(2)) == 0).alias("fits")), "labelled")


class Models:
    """Log target minus log raw, and what tells toxic documents, by bucket: tables of fixed size."""

    def __init__(self, ratio: np.ndarray, toxic: np.ndarray):
        self.ratio, self.toxic = ratio, toxic

    def judge(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log importance weight and toxic evidence of each text."""
        bucket, doc = ngram_buckets(texts, len(self.toxic))  # a bucket of the larger table tells that of the smaller one
        weight = np.bincount(doc, weights=self.ratio[bucket % len(self.ratio)], minlength=len(texts)).astype(float)
        told = np.flatnonzero(self.toxic[bucket])
        key = np.unique(doc[told] * len(self.toxic) + bucket[told])
        evidence = np.bincount(key // len(self.toxic), weights=self.toxic[key % len(self.toxic)], minlength=len(texts)).astype(float)
        return weight, evidence


def fit(docs: DataFrame, sample: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS, toxic_buckets: int = TOXIC_BUCKETS, smooth: float = SMOOTH) -> Models:
    """The models, counted in one pass over all documents. ``toxic_buckets`` must be a multiple of ``buckets``."""
    if toxic_buckets % buckets:
        raise ValueError("toxic_buckets must be a multiple of buckets")
    known = F.broadcast(sample.filter("fits").select("label_id", "good", "toxic"))  # at most FIT_ROWS rows
    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    marked = slim.join(known, F.col("doc_id") == F.col("label_id"), "left").select("text", "good", "toxic")
    counts = marked.mapInArrow(_count(buckets, toxic_buckets), "bucket bigint, a bigint, b bigint").groupBy("bucket").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toArrow()  # a row per bucket
    n_toxic, n_other = sample.filter("fits").agg(F.count_if("toxic"), F.count_if(~F.col("toxic"))).first()
    a, b = np.zeros(buckets + toxic_buckets), np.zeros(buckets + toxic_buckets)
    at = counts.column("bucket").to_numpy()
    a[at], b[at] = counts.column("a").to_numpy(), counts.column("b").to_numpy()
    raw, target = a[:buckets], b[:buckets]
    part = lambda x: np.log((x + smooth) / (x.sum() + smooth * buckets))
    ratio = part(target) - part(raw) if target.sum() else np.zeros(buckets)
    toxic = np.zeros(toxic_buckets)
    if n_toxic and n_other:
        log = np.log((a[buckets:] + smooth) / (b[buckets:] * (n_toxic / n_other) + smooth))
        toxic = np.where(log >= TELLING, log, 0.0)
    return Models(ratio, toxic)


def weigh(docs: DataFrame, models: Models, text: str = "text", weight: str = "log_weight", evidence: str = "evidence") -> DataFrame:
    """All columns of ``docs``, the log importance weight and the toxic evidence of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks_of(batches, text, PART_BYTES):
            w, e = shared.value.judge(batch.column(batch.schema.get_field_index(text)).fill_null(""))
            yield batch.append_column(weight, pa.array(w, pa.float64())).append_column(evidence, pa.array(e, pa.float64()))

    schema = T.StructType([*docs.schema.fields, T.StructField(weight, T.DoubleType()), T.StructField(evidence, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def chunks_of(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """As :func:`common.chunks`, but nulls in ``text`` stay nulls in the batch that is passed on."""
    for batch in batches:
        (sized,) = fresh(batch.schema.names, "sized")
        for part in chunks([batch.append_column(sized, pc.fill_null(batch.column(batch.schema.get_field_index(text)), ""))], sized, limit):
            yield part.drop_columns([sized])


def gumbel_key(weight: str = "log_weight", doc_id: str = "doc_id", seed: int = SEED):
    """Log weight plus standard Gumbel noise that only depends on the id and the seed."""
    h = F.xxhash64(F.col(doc_id).cast("bigint"), F.lit(seed))
    u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return F.col(weight) - F.log(-F.log(u))


def kth_largest(keys: DataFrame, k: int) -> tuple[float, int | None]:
    """Key and id of the k-th row by (key descending, id ascending, null id last). ``keys``: doc_id, key."""
    lo, hi = keys.agg(F.min("key"), F.max("key")).first()
    rows, above = keys, 0
    while lo < hi:
        width = (hi - lo) / BINS
        bin_of = F.least(F.floor((F.col("key") - F.lit(lo)) / F.lit(width)), F.lit(BINS - 1))
        hist = sorted(((r["b"], r["n"], r["lo"], r["hi"]) for r in rows.groupBy(bin_of.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect()), reverse=True)
        for _, n, new_lo, new_hi in hist:
            if above + n >= k:
                break
            above += n
        rows, lo, hi = keys.filter(F.col("key").between(new_lo, new_hi)), new_lo, new_hi
        if n <= FEW:
            part = sorted(((r["key"], r["doc_id"]) for r in rows.collect()), key=lambda r: (-r[0], r[1] is None, r[1] or 0))
            return part[k - above - 1]
    return lo, None  # all rows left have the same key: they stay together


def threshold(scored: list[tuple[float, bool]]) -> float:
    """The weight that separates good from bad labelled documents best (balanced accuracy; of equals the lowest)."""
    values = np.array([s for s, _ in scored])
    good = np.array([g for _, g in scored], bool)
    if not len(values) or good.all() or not good.any():
        return -np.inf
    order = np.argsort(values, kind="stable")
    values, good = values[order], good[order]
    kept_good = 1 - np.concatenate([[0], np.cumsum(good)]) / good.sum()
    dropped_bad = np.concatenate([[0], np.cumsum(~good)]) / (~good).sum()
    at = np.flatnonzero(np.concatenate([[True], values[1:] > values[:-1], [True]]))
    best = at[np.argmax((kept_good + dropped_bad)[at])]
    return float(-np.inf if best == 0 else np.inf if best == len(values) else (values[best - 1] + values[best]) / 2)


def highest_evidence(known: list[tuple[float, bool]], loss: float = LOSS) -> float:
    """The least limit that at most a share ``loss`` of the documents that are not toxic exceed; never below zero."""
    clean = np.sort([e for e, toxic in known if not toxic])
    if len(clean) in (0, len(known)):
        return np.inf
    return float(clean[len(clean) - 1 - int(loss * len(clean))])


class Decision:
    """The fitted models, the limit of the evidence, and the last key and id that are kept."""

    def __init__(self, models: Models, limit: float, last: tuple[float, int | None]):
        self.models, self.limit, self.last = models, limit, last

    def keeps(self, key, evidence, doc_id):
        """A tie on the key is settled by the id; a null id comes last."""
        key_at, id_at = self.last
        above = key >= F.lit(key_at) if id_at is None else (key > F.lit(key_at)) | (key == F.lit(key_at)) & F.coalesce(doc_id <= F.lit(id_at), F.lit(False))
        return above & (evidence <= F.lit(self.limit))


def decide(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS) -> tuple[Decision, DataFrame]:
    """What is kept, and doc_id, log_weight, evidence and key of every document."""
    sample = labelled_sample(labels, fit_rows)
    models = fit(docs, sample, doc_id, text)
    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    keys = stored(weigh(slim, models).select("doc_id", "log_weight", "evidence", gumbel_key().alias("key")), "keys")
    apart = F.broadcast(sample.filter(~F.col("fits")))  # at most FIT_ROWS rows; of repeated ids the first row by weight counts
    known = keys.join(apart, keys["doc_id"] == apart["label_id"]).groupBy("label_id").agg(F.min(F.struct("log_weight", "evidence", "good", "toxic")).alias("k")).select("k.*").collect()
    limit = highest_evidence([(r["evidence"], r["toxic"]) for r in known])
    least = threshold([(r["log_weight"], r["good"]) for r in known if r["evidence"] <= limit])
    drawn = keys.filter(F.col("evidence") <= F.lit(limit)).select("doc_id", "log_weight", "key")
    k = drawn.filter(F.col("log_weight") >= F.lit(least)).count()
    return Decision(models, limit, kth_largest(drawn, k) if k else (float("inf"), None)), keys


def quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, log_weight, evidence (of toxicity), key (with noise), kept."""
    decision, keys = decide(docs, labels, doc_id, text)
    return keys.select("doc_id", "log_weight", "evidence", "key", decision.keeps(F.col("key"), F.col("evidence"), F.col("doc_id")).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are kept, all columns. Weights are computed again here, which saves shuffling the texts."""
    decision, _ = decide(docs, labels, doc_id, text)
    weight, evidence = fresh(docs.columns, "log_weight", "evidence")
    weighed = weigh(docs, decision.models, text, weight, evidence)
    return weighed.filter(decision.keeps(gumbel_key(weight, doc_id), F.col(evidence), F.col(doc_id).cast("bigint"))).drop(weight, evidence)
