"""Scoring texts with a causal self-attention model on subword ids, next to a unigram word model.

Everything is learned from the documents that are not held out (crc32 of the id's text, modulo 10, is not 0). A text is
its sequence of words (A-Z lower-cased) and an end.

1. One scan counts the words and subwords of every training document and writes its subword ids as segments. A hash of
   the document and of the segment's number deals segments to rounds and, within a round, to buckets.
2. Each round takes Adam steps over its part of the corpus: every bucket on its own from the same weights, over windows
   that tile its segments, in the order of the hash. A tree of grouped sums averages the buckets by windows. So each
   subword of every training text is a target once, and the weights depend neither on partitions nor on their order.
3. A second scan scores all texts: windows overlap by half, and each subword is scored once, with 32 to 63 subwords
   before it. A text's score is the sum of the model's log10 probabilities of its subwords and of its end, nothing else.

Base: words that are frequent in training are looked up in a broadcast of at most ``HEAD`` words; the occurrences of
others go through one join with the counts.

Cases: null text counts as empty (its end is still a token and is scored); a null id is held out; repeated rows are
trained on and scored each; without training documents the base is that of empty counts and the model that of random
weights; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import attention as A
from tidemark.llm.common import chunks, pieces, stored, words_of
from tidemark.llm.subwords import encoder
from tidemark.llm.token_files import default_tokenizer

#: Words in the broadcast head; smoothing of the base.
HEAD, SMOOTH = 200_000, 0.1
#: Windows of a segment at most; rounds; windows of a bucket, of an Adam step; buckets averaged at once; first step size.
SEGMENT, ROUNDS, BUCKET, BATCH, FAN, RATE = 32, 6, 32_768, 64, 16, 0.01
#: Distinct words that a task of the scan holds before it hands their counts on.
HELD_WORDS = 250_000
_SCAN = "part int, word string, subword bigint, n bigint, key bigint, doc_id bigint, segment bigint, ids binary"
_COLUMNS = {"part": pa.int32(), "word": pa.string(), "subword": pa.int64(), "n": pa.int64(), "key": pa.int64(), "doc_id": pa.int64(), "segment": pa.int64(), "ids": pa.binary()}
_SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, known bigint, head double, score double, tail array<string>"
_COUNTS = -1  # the part of the scan that holds counts; others are rounds


class Spelling:
    """The words of a batch of texts: distinct words, which one stands where, and subword ids."""

    def __init__(self, texts: pa.Array, path: str):
        words, self.per = words_of(texts)
        coded = words.dictionary_encode()
        self.words, self.which = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # A blank before each word: no subword reaches over two words.
        self.flat, self.size = encoder(path).encode(pc.binary_join_element_wise(pa.scalar(""), self.words, pa.scalar(" ")))

    def ids(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Subword ids of all texts, their number in each text, and the number in each word."""
        per_word = self.size[self.which]
        ends = np.cumsum(per_word)
        first = np.cumsum(self.size) - self.size
        index = np.repeat(first[self.which] - (ends - per_word), per_word) + np.arange(int(ends[-1]) if len(ends) else 0)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(self.per)])]
        return self.flat[index].astype(np.int64), np.diff(bounds), per_word


def _rows(size: int, **columns: pa.Array) -> pa.RecordBatch:
    return pa.record_batch([columns[name] if name in columns else pa.nulls(size, t) for name, t in _COLUMNS.items()], list(_COLUMNS))


def _mixed(doc_ids: np.ndarray, segments: np.ndarray) -> np.ndarray:
    """63 well-mixed bits of a document and a segment's number."""
    with np.errstate(over="ignore"):
        x = doc_ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + segments.astype(np.uint64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(1)).astype(np.int64)


def _id_type(end: int) -> np.dtype:
    """How ids up to ``end`` are written."""
    return np.dtype("<u2" if end < 1 << 16 else "<u4")


def segments_of(ids: np.ndarray, sizes: np.ndarray, doc_ids: np.ndarray, end: int, rounds: int = ROUNDS) -> pa.RecordBatch:
    """Segments of all texts: up to ``SEGMENT`` windows of targets, with the two ids before them. The end stands before and behind a text."""
    stop = np.cumsum(sizes)
    text = np.insert(ids, np.repeat(np.concatenate([stop - sizes, stop]), np.repeat([2, 1], len(sizes))), end) if len(sizes) else ids
    first = np.cumsum(sizes + 3) - (sizes + 3)
    span = SEGMENT * A.WINDOW
    n = -(-(sizes + 1) // span)  # targets: the subwords and the end
    doc = np.repeat(np.arange(len(sizes)), n)
    number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = first[doc] + number * span
    length = np.minimum(span, sizes[doc] + 1 - number * span) + 2
    key = _mixed(doc_ids[doc], number)
    at = np.cumsum(length)
    flat = text[np.repeat(start - (at - length), length) + np.arange(int(at[-1]) if len(at) else 0)].astype(kind := _id_type(end))
    packed = pieces(flat.view(np.uint8), np.concatenate([[0], at]) * kind.itemsize, pa.binary())
    return _rows(len(doc), part=pa.array((key % rounds).astype(np.int32)), n=pa.array(-(-(length - 2) // A.WINDOW)), key=pa.array(key // rounds), doc_id=pa.array(doc_ids[doc]), segment=pa.array(number), ids=packed)


def _scan(path: str, size: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        held = []

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        def handed_on() -> Iterator[pa.RecordBatch]:
            for b in merged().to_batches(max_chunksize=100_000):
                yield _rows(b.num_rows, part=pa.array(np.full(b.num_rows, _COUNTS, np.int32)), word=b.column("word"), n=b.column("n"))
            held.clear()

        for batch in chunks(batches, limit=4 << 20):
            s = Spelling(batch.column("text"), path)
            n = np.bincount(s.which, minlength=len(s.words))
            counts += np.bincount(s.flat, weights=np.repeat(n, s.size), minlength=size).astype(np.int64)
            held.append(pa.table({"word": s.words, "n": pa.array(n)}))
            if sum(len(t) for t in held) > 2 * HELD_WORDS:
                held[:] = [merged()]
                if len(held[0]) > HELD_WORDS:
                    yield from handed_on()
            ids, sizes, _ = s.ids()
            yield segments_of(ids, sizes, batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64), size - 1, rounds)
        if held:
            yield from handed_on()
        at = np.flatnonzero(counts)
        yield _rows(len(at), part=pa.array(np.full(len(at), _COUNTS, np.int32)), subword=pa.array(at), n=pa.array(counts[at]))

    return run


def windows_in(ids: list[bytes], end: int) -> np.ndarray:
    """Windows that tile the segments: WINDOW targets and the two ids before them; -1 behind a text's end."""
    out = []
    for raw in ids:
        text = np.frombuffer(raw, _id_type(end)).astype(np.int32)
        n = -(-(len(text) - 2) // A.WINDOW)
        padded = np.full(n * A.WINDOW + 2, -1, np.int32)
        padded[: len(text)] = text
        out.append(np.lib.stride_tricks.sliding_window_view(padded, A.WINDOW + 2)[:: A.WINDOW])
    return np.concatenate(out)


_MODEL = pa.schema([("bucket", pa.int64()), ("windows", pa.int64()), ("weights", pa.binary())])


def _train(shared, rate: float, batch: int):
    def run(bucket: pa.Table) -> pa.Table:
        A.keep_pages()
        flat, vocabulary = shared.value
        bucket = bucket.sort_by([(c, "ascending") for c in ("key", "doc_id", "segment")])
        w = windows_in(bucket.column("ids").to_pylist(), len(vocabulary.rank) - 1)
        flat = A.train_locally(flat, vocabulary, w, rate, batch)
        return pa.table([bucket.column("bucket").slice(0, 1), [len(w)], [flat.tobytes()]], schema=_MODEL)

    return run


def _average(models: pa.Table) -> tuple[int, np.ndarray]:
    """Windows and weighted mean of the models, taken in the order of their buckets."""
    models = models.sort_by("bucket")
    n = models.column("windows").to_numpy()
    total = 0.0
    for k, raw in zip(n.tolist(), models.column("weights"), strict=True):
        total = total + k * np.frombuffer(raw.as_buffer(), np.float32).astype(np.float64)
    return int(n.sum()), (total / n.sum()).astype(np.float32)


def _merge(models: pa.Table) -> pa.Table:
    windows, flat = _average(models)
    return pa.table([[models.column("bucket")[0].as_py() // FAN], [windows], [flat.tobytes()]], schema=_MODEL)


def train(segments: DataFrame, counts: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, batch: int = BATCH, bucket: int = BUCKET) -> tuple[np.ndarray, A.Vocabulary]:
    """Weights after one pass over all segments (part, n, key, doc_id, segment, ids), and the vocabulary."""
    vocabulary = A.Vocabulary(counts)
    flat = A.start_weights(vocabulary)
    sizes = {r["part"]: r["n"] for r in segments.groupBy("part").agg(F.sum("n").alias("n")).collect()}  # a row per round
    schema = "bucket bigint, windows bigint, weights binary"
    for k in range(rounds):
        if not sizes.get(k):
            continue
        buckets = -(-sizes[k] // bucket)
        shared = segments.sparkSession.sparkContext.broadcast((flat, vocabulary))
        step = rate * 0.5 * (1 + math.cos(math.pi * k / rounds))
        part = segments.filter(F.col("part") == k).select(F.pmod("key", F.lit(buckets)).cast("bigint").alias("bucket"), "key", "doc_id", "segment", "ids")
        models = part.groupBy("bucket").applyInArrow(_train(shared, step, batch), schema)
        while buckets > FAN:
            models = models.groupBy(F.floor(F.col("bucket") / FAN)).applyInArrow(_merge, schema)
            buckets = -(-buckets // FAN)
        flat = _average(models.toArrow())[1]  # at most FAN models reach the driver
        shared.unpersist()
    return flat, vocabulary


def _score(shared, path: str):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("head", pa.float64()), ("score", pa.float64()), ("tail", pa.list_(pa.string()))])

    def some(batch: pa.RecordBatch, model: dict, scorer: A.Scorer) -> pa.RecordBatch:
        s = Spelling(batch.column("text"), path)
        per, n_texts = s.per, batch.num_rows
        ids, sizes, _ = s.ids()
        logs = scorer.log10(ids, sizes, model["size"] - 1)
        score = np.bincount(np.repeat(np.arange(n_texts), sizes + 1), weights=logs, minlength=n_texts)
        found = pc.fill_null(pc.index_in(s.words, value_set=model["words"]), -1).to_numpy(zero_copy_only=False)
        count = np.where(found >= 0, np.append(model["counts"], 0)[found], 0)[s.which]
        base = np.log10((count + SMOOTH) / model["total"])
        doc = np.repeat(np.arange(n_texts), per)
        here = count > 0
        head = np.bincount(doc[here], weights=base[here], minlength=n_texts) + np.log10((model["ends"] + SMOOTH) / model["total"])
        known = np.bincount(doc[here], minlength=n_texts) + int(model["ends"] > 0)
        rare = np.flatnonzero(~here)
        tail = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc[rare], minlength=n_texts))]).astype(np.int32)), s.words.take(pa.array(s.which[rare])))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(per + 1), pa.array(known), pa.array(head), pa.array(score), tail], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        A.keep_pages()
        model = shared.value
        scorer = A.Scorer(model["flat"], model["vocabulary"])
        for batch in chunks(batches, limit=3 << 20):
            yield some(batch, model, scorer)

    return run


def _head_words(words: DataFrame, most: int) -> tuple[pa.Array, np.ndarray]:
    """The words whose count reaches the least power of two that no more than ``most`` words reach."""
    bins = {r["b"]: r["k"] for r in words.groupBy(F.floor(F.log2("n")).alias("b")).agg(F.count(F.lit(1)).alias("k")).collect()}
    least, kept = 62, 0
    while least > 0 and kept + bins.get(least - 1, 0) <= most:
        least -= 1
        kept += bins.get(least, 0)
    rows = words.filter(F.col("n") >= F.lit(1 << least)).collect()  # at most ``most``
    return pa.array([r["word"] for r in rows], pa.string()), np.array([r["n"] for r in rows], np.int64)


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer_path: str | None = None, head: int = HEAD, batch: int = BATCH) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    path = tokenizer_path or default_tokenizer()
    size = encoder(path).tokenizer.get_vocab_size()
    key = F.col(doc_id).cast("bigint")
    held = F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 10 == 0
    slim = docs.select(key.alias("doc_id"), F.col(text).cast("string").alias("text"), held.alias("held_out"))
    training = slim.filter(~F.col("held_out"))
    scan = stored(training.select("doc_id", "text").mapInArrow(_scan(path, size, ROUNDS), _SCAN), "scan", by="part")
    counted = scan.filter(F.col("part") == _COUNTS)

    words = stored(counted.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n")), "words")
    distinct, tokens = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    ends = training.count()
    tokens, distinct = tokens + ends, distinct + int(ends > 0)
    total = float(tokens + SMOOTH * (distinct + 1))

    counts = np.zeros(size)
    for r in counted.filter(F.col("subword").isNotNull()).groupBy("subword").agg(F.sum("n").alias("n")).collect():  # one row per subword
        counts[r["subword"]] = r["n"]
    counts[size - 1] += ends
    flat, vocabulary = train(scan.filter(F.col("part") >= 0), counts, batch=batch)

    head_words, head_counts = _head_words(words, head)
    model = {"flat": flat, "vocabulary": vocabulary, "words": head_words, "counts": head_counts, "total": total, "ends": ends, "size": size}
    scored = slim.mapInArrow(_score(spark.sparkContext.broadcast(model), path), _SCORED)
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), "scored")

    rare = scored.select("row", F.explode("tail").alias("w"))
    joined = rare.join(words, rare["w"] == words["word"], "left").select("row", F.coalesce("n", F.lit(0)).alias("c"))
    tail = joined.groupBy("row").agg(F.sum(F.log10((F.col("c") + F.lit(SMOOTH)) / F.lit(total))).alias("tail"), F.count_if(F.col("c") > 0).alias("tail_known"))
    out = scored.drop("tail").join(tail, "row", "left")
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"), F.lit(int(tokens)).cast("bigint").alias("train_tokens"),
        (F.col("head") + F.coalesce("tail", F.lit(0.0))).alias("base_score"), "score",
    )
