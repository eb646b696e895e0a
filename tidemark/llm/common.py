"""Plumbing shared by the llm operators: the shared work folder, stored tables and vectorised text splitting.

Executors can be lost at any time, so nothing is kept in executor memory or in machine-local folders. A table that is
used twice is written as Parquet below the folder named by ``spark.checkpoint.dir`` and read back, which also cuts the
lineage.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_base, ship

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word: anything but space and the five control characters from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes that a Python worker handles at once, and that one Arrow batch between Spark and a worker holds.
CHUNK_BYTES, BATCH_BYTES = 2 << 20, 8 << 20

# Workers give memory back to the system as soon as a chunk is done; the default pool would keep it.
pa.set_memory_pool(pa.system_memory_pool())

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_TO_LOWER = np.arange(256, dtype=np.uint8)
_TO_LOWER[65:91] += 32


def prepared(spark: SparkSession) -> SparkSession:
    """The session, with this package on its workers and Arrow batches bounded by bytes, so that very long texts don't fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return ship(spark)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, empty place below ``spark.checkpoint.dir``, as a URI. Only a local session may leave that unset."""
    base = shared_base(prepared(spark))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}")
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lost executor costs no recomputation beyond this table. ``by``: partition column."""
    path = shared_dir(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(taken: list[str], *names: str) -> list[str]:
    """The names, with underscores behind them until they clash neither with ``taken`` nor with each other."""
    used, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` is much faster than ``translate`` and equal to it on pure ASCII."""
    return F.when(F.length(col) == F.octet_length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


#: Keys with more than one row in so many are looked up in a broadcast instead of being shuffled to one task.
HOT_KEYS = 1024


def join_keyed(left: DataFrame, right: DataFrame, key: str, size: str, total: int, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``, which has one row per ``key`` and in ``size`` how many rows of ``left`` have it.

    ``total``: rows of ``left``. At most ``HOT_KEYS`` keys hold more than total / HOT_KEYS rows each: those are
    broadcast, and the shuffle only sees the others. ``how``: inner or left. ``size`` is dropped.
    """
    least = total / HOT_KEYS
    hot = F.broadcast(right.filter(F.col(size) > least).drop(size))
    cold = right.filter(F.col(size) <= least).drop(size)
    apart = left.join(F.broadcast(right.filter(F.col(size) > least).select(key)), key, "left_anti")
    return left.join(hot, key).unionByName(apart.join(cold.hint("merge"), key, how))


def first_rows(docs: DataFrame, groups: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The row of each group with the smallest id, null last; of rows with equal id and text a single one stays.

    ``groups`` has a row per row of ``docs``: doc_id, digest (xxhash64 of the text) and root. Rows are told apart by id
    and digest, so neither null nor repeated ids join rows of different texts.
    """
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
    chosen = groups.groupBy("root", first.alias("row")).agg(F.count(F.lit(1)).alias("n"))
    chosen = stored(chosen.groupBy("root").agg(F.min_by(F.struct("row.*", "n"), "row").alias("c")).select("c.*"), "kept")
    # The rows that stay grow with the input, so they are never broadcast: the same plan at every size.
    kept = chosen.select("_id", "_digest").hint("merge")
    mark = F.xxhash64(docs[text].cast("string"))
    out = docs.join(kept, docs[doc_id].cast("bigint").eqNullSafe(kept["_id"]) & (mark == kept["_digest"]), "left_semi")
    if chosen.filter("n > 1").isEmpty():
        return out
    (digest,) = fresh(docs.columns, "digest")
    return out.withColumn(digest, F.xxhash64(F.col(text).cast("string"))).dropDuplicates([doc_id, digest]).drop(digest)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each has about ``limit`` bytes of text, or a single row. Nulls in ``text`` become empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(text)
        batch = batch.set_column(at, text, pc.fill_null(batch.column(at), ""))
        ends = np.cumsum(pc.binary_length(batch.column(at)).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts behind one another, and len + 1 offsets."""
    if pa.types.is_large_string(texts.type) or pa.types.is_string_view(texts.type):
        texts = texts.cast(pa.string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def pieces(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """Slices of one buffer as an Arrow array."""
    return pa.Array.from_buffers(kind or pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words, A-Z lower-cased, and the number of words of each text."""
    data, off = utf8_of(texts)
    n = len(data)
    sep = _SEPARATOR[data]
    first = np.ones(n, dtype=bool)
    first[1:] = sep[:-1]
    first[off[:-1][off[:-1] < n]] = True
    at = np.flatnonzero(first & ~sep)
    per = np.diff(np.searchsorted(at, off))
    kept = np.flatnonzero(~sep)
    starts = np.searchsorted(kept, at)
    return pieces(_TO_LOWER[data[kept]], np.append(starts, len(kept))), per


def groups_of(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by ``by``; yields the rows of each group, which may lie in several batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([batch.column(c).to_numpy() for c in by])
        cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in itertools.pairwise(cuts):
            own = tuple(marks[:, a].tolist())
            if held and own != last:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = own
    if held:
        yield pa.concat_batches(held)


def hooked(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``root`` after the ends of every link (i, j) got the same root."""
    while True:
        a, b = root[i], root[j]
        open_ = a != b
        if not open_.any():
            return root
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        root = root.copy()
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root, jumped := root[root]):
            root = jumped
