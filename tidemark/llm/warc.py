"""WARC files and their fixity audit by Merkle trees.

:func:`write` stores pages as gzipped WARC shards, one gzip member per record, and gives the capture index. The audit
reads the files of two replicas record by record, hashes every record, and builds a tree per file over the ordered
offset ranges: each inner node hashes its children's ranges and hashes. Roots are compared first, and only the children
of nodes that differ are compared on the next level, down to the suspect records. A lost or surplus record moves all
behind it, so suspects are then aligned within their file: first by the hash of their bytes (those are sound, wherever
they stand), then by record id, then by their turn between two neighbours that are aligned. What has no counterpart is
missing in the other replica.

All levels are grouped sums of at most ``FANOUT`` rows, so no task sees more than one file's records at once and the
driver sees none. A shard is written under its own name and then moved, so a repeated task replaces the same bytes.

Reading goes on behind a damaged gzip member at the next one that starts with a WARC record; the magic number may also
occur by chance. If that start is damaged too, both records are read as one damaged member: one of them then counts as
corrupt, the other as missing.

Cases: null html or url counts as empty; null ids come first and are written without one; repeated rows give a record
each, in order of their bytes; an empty table gives no files and an empty audit; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import shared_dir, stored
from tidemark.llm.quality import chunks_of

#: Children of an inner node; bytes of records after which a task starts a new file; the date of made-up captures.
FANOUT, SHARD_BYTES, DATE = 16, 64 << 20, "2024-01-01T00:00:00Z"
_MAGIC, _LOOK = b"\x1f\x8b\x08", 512
Damage = Callable[[int | None, bytes], bytes | None]
_INDEX = "file string, record bigint, offset bigint, length bigint, page_id bigint"


def record(page_id: int | None, url: str | None, html: str | None, date: str = DATE) -> bytes:
    """One response record of WARC/1.1. Its id is made from its content, so the same page gives the same bytes."""
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (html or "").encode()
    block = hashlib.sha256(body).hexdigest()
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}|{url}|{block}")
    head = (
        f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:{name}>\r\nWARC-Date: {date}\r\nWARC-Target-URI: {re.sub(chr(13) + '|' + chr(10), '', url or '')}\r\n"
        f"WARC-Block-Digest: sha256:{block}\r\nWARC-Page-ID: {'' if page_id is None else page_id}\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: {len(body)}\r\n\r\n"
    )
    return head.encode() + body + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def parse(data: bytes) -> dict:
    """Header fields (lower-case names) and the block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    size = int(fields.get("content-length", 0))
    return {"version": lines[0], "fields": fields, "block": rest[:size], "whole": len(rest) >= size}


def _starts_record(data: bytes) -> bool:
    """Whether a gzip member that holds a WARC record starts here."""
    try:
        return zlib.decompressobj(31).decompress(data, 5) == b"WARC/"
    except zlib.error:
        return False


def members(read: Callable[[int], bytes], step: int = 1 << 20) -> Iterator[tuple[int, bytes, bytes]]:
    """Offset, raw bytes and content of each gzip member of a stream, one at a time in memory. A member that can't be read ends where the next record starts."""
    held, base, more = b"", 0, True

    def fill() -> bool:
        nonlocal held, more
        got = read(step) if more else b""
        more = bool(got)
        held += got
        return more

    def next_start() -> int:
        at = 1
        while True:
            at = held.find(_MAGIC, at)
            if at < 0:
                at = max(1, len(held) - len(_MAGIC) + 1)
                if not fill():
                    return len(held)
                continue
            while len(held) < at + _LOOK and fill():
                pass
            if _starts_record(held[at : at + _LOOK]):
                return at
            at += 1

    while held or fill():
        z, at, out, broken = zlib.decompressobj(31), 0, [], False
        try:
            while not z.eof:
                if at == len(held) and not fill():
                    broken = True
                    break
                piece = held[at:]
                out.append(z.decompress(piece))
                at = len(held) - len(z.unused_data) if z.eof else len(held)
        except zlib.error:
            broken = True
        if broken:
            at = next_start()
        yield base, held[:at], b"" if broken else b"".join(out)
        held, base = held[at:], base + at


class _Sink:
    """The open shard of one replica in one task."""

    def __init__(self, uri: str, damage: Damage | None):
        self.store, self.base = fs.FileSystem.from_uri(uri)
        self.damage, self.part, self.serial = damage, TaskContext.get().partitionId(), 0
        self.file, self.own, self.name, self.at, self.n = None, "", "", 0, 0

    def put(self, page_id: int | None, raw: bytes) -> tuple | None:
        """Where the record went, or None if the replica lost it."""
        raw = self.damage(page_id, raw) if self.damage else raw
        if raw is None:
            return None
        if self.file is None:
            self.name, self.own = f"part-{self.part:06d}-{self.serial:05d}.warc.gz", f"{self.base}/.{uuid.uuid4().hex}"
            self.file = self.store.open_output_stream(self.own, compression=None)
        self.file.write(raw)
        row = (self.name, self.n, self.at, len(raw), page_id)
        self.at, self.n = self.at + len(raw), self.n + 1
        return row

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.store.move(self.own, f"{self.base}/{self.name}")
            self.file, self.serial, self.at, self.n = None, self.serial + 1, 0, 0


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages as compressed records: what is shuffled then is a third of the text."""
    for batch in chunks_of(batches, "html"):
        rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True)
        yield pa.record_batch([batch.column("page_id"), pa.array([member(record(*r)) for r in rows], pa.binary())], ["page_id", "raw"])


def _write(replicas: list[tuple[str, Damage | None]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sinks = [_Sink(uri, damage) for uri, damage in replicas]
        whole = 0  # bytes of the sound records: all replicas begin a new file at the same record
        for batch in batches:
            rows = []
            for page_id, raw in zip(batch.column("page_id").to_pylist(), batch.column("raw").to_pylist(), strict=True):
                found = [s.put(page_id, raw) for s in sinks]
                if found[0]:
                    rows.append(found[0])
                whole += len(raw)
                if whole >= SHARD_BYTES:
                    whole = 0
                    for s in sinks:
                        s.close()
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["file", "record", "offset", "length", "page_id"])
        for s in sinks:
            s.close()

    return run


def write_replicas(pages: DataFrame, damages: list[Damage | None]) -> tuple[list[str], DataFrame]:
    """Write several replicas of the pages in one pass, in order of their id. Returns their folders and the index of the first: file, record, offset, length, page_id.

    A damage stands for a faulty replica in drills: it maps a record's id and bytes to what is stored (None: lost).
    """
    spark = pages.sparkSession
    uris = [shared_dir(spark, "warc") for _ in damages]
    for uri in uris:
        store, base = fs.FileSystem.from_uri(uri)
        store.create_dir(base)
    slim = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    ordered = slim.mapInArrow(_members, "page_id bigint, raw binary").repartitionByRange("page_id").sortWithinPartitions("page_id", "raw")
    return uris, stored(ordered.mapInArrow(_write(list(zip(uris, damages, strict=True))), _INDEX), "cdx")


def write(pages: DataFrame, damage: Damage | None = None) -> tuple[str, DataFrame]:
    """One replica: its folder and index."""
    uris, index = write_replicas(pages, [damage])
    return uris[0], index


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, name in zip(batch.column("uri").to_pylist(), batch.column("file").to_pylist(), strict=True):
            store, base = fs.FileSystem.from_uri(uri)
            rows = []
            with store.open_input_stream(f"{base}/{name}", compression=None) as f:
                for n, (at, raw, content) in enumerate(members(f.read)):
                    found = parse(content) if content else {"fields": {}, "block": b"", "whole": False}
                    said = found["fields"].get("warc-block-digest", "")
                    sound = found["whole"] and said == "sha256:" + hashlib.sha256(found["block"]).hexdigest()
                    page = found["fields"].get("warc-page-id", "")
                    rows.append((name, n, at, len(raw), hashlib.sha256(raw).digest(), int(page) if page.lstrip("-").isdigit() else None, sound, found["fields"].get("warc-record-id")))
                    if len(rows) == 4096:
                        yield _leaves(rows)
                        rows = []
            if rows:
                yield _leaves(rows)


def _leaves(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.bool_(), pa.string())
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["file", "record", "offset", "length", "hash", "page_id", "sound", "name"])


def leaves(spark: SparkSession, uri: str) -> DataFrame:
    """Every record of a replica's files: file, record, offset, length, hash (SHA-256 of the stored bytes), page_id, sound, name (its id). One task per file."""
    store, base = fs.FileSystem.from_uri(uri)
    names = sorted(i.base_name for i in store.get_file_info(fs.FileSelector(base)) if i.base_name.endswith(".warc.gz"))
    schema = "file string, record bigint, offset bigint, length bigint, hash binary, page_id bigint, sound boolean, name string"
    if not names:
        return spark.createDataFrame([], schema)
    return spark.createDataFrame([(uri, n) for n in names], "uri string, file string").coalesce(1).repartition(len(names)).mapInArrow(_read, schema)


def _parent(nodes: DataFrame, fanout: int) -> DataFrame:
    """The next level: hash over the ordered children's ranges and hashes. Groups have at most ``fanout`` rows."""
    children = F.array_sort(F.collect_list(F.struct("node", "first", "end", "hash")))
    told = F.concat_ws(";", F.transform(children, lambda c: F.concat_ws(":", c["first"].cast("string"), c["end"].cast("string"), F.hex(c["hash"]))))
    return nodes.groupBy("file", F.floor(F.col("node") / fanout).alias("node")).agg(F.min("first").alias("first"), F.max("end").alias("end"), F.unhex(F.sha2(told.cast("binary"), 256)).alias("hash"))


def tree(records: DataFrame, fanout: int = FANOUT, depth: int | None = None) -> list[DataFrame]:
    """The levels from the records (0) to one root per file: file, node, first, end, hash."""
    level = records.select("file", F.col("record").alias("node"), F.col("offset").alias("first"), (F.col("offset") + F.col("length")).alias("end"), "hash")
    out = [level]
    if depth is None:
        most = records.agg(F.max("record")).first()[0]
        depth = 0
        while most is not None and fanout**depth <= most:
            depth += 1
    for k in range(depth):
        out.append(stored(_parent(out[-1], fanout), f"level{k + 1}"))
    return out


def _differs() -> Column:
    return ~(F.col("a.hash").eqNullSafe(F.col("b.hash")) & F.col("a.first").eqNullSafe(F.col("b.first")) & F.col("a.end").eqNullSafe(F.col("b.end")))


def compare(a: list[DataFrame], b: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """file and node of the records that differ, found from the roots down: only children of differing nodes are compared."""
    suspects: DataFrame | None = None
    for x, y in zip(reversed(a), reversed(b), strict=True):
        if suspects is not None:
            near = suspects.select(F.col("file").alias("_f"), F.col("node").alias("_n"))
            x, y = (t.join(near, (F.col("file") == F.col("_f")) & (F.floor(F.col("node") / fanout) == F.col("_n")), "left_semi") for t in (x, y))
        both = x.alias("a").join(y.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("a.node") == F.col("b.node")), "full")
        suspects = stored(both.filter(_differs()).select(F.coalesce("a.file", "b.file").alias("file"), F.coalesce("a.node", "b.node").alias("node")), "suspects")
    return suspects


def _number_within(rows: DataFrame, *key: str) -> DataFrame:
    """With ``turn``: the place of a record among those of its file with the same key."""
    return rows.withColumn("turn", F.row_number().over(Window.partitionBy("file", *key).orderBy("record")))


def align(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs of suspect records: file, record_a, record_b (null: no counterpart). Windows hold the suspects of one file at most.

    Of records with equal bytes the n-th of one replica goes with the n-th of the other; likewise for ids. Damaged
    records that tell no id are paired by their turn behind the last record before them that is aligned, those of equal
    length first.
    """

    def paired(x: DataFrame, y: DataFrame, *key: str, either: str | None = None) -> DataFrame:
        """Pairs with equal keys and turns; with ``either``, one of them must lack that column."""
        x, y = (_number_within(t.filter(F.col(key[0]).isNotNull()), *key).select("file", "turn", "record", "name", *(c for c in key if c != "name")) for t in (x, y))
        on = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in ("file", *key, "turn")]
        if either:
            on.append(F.col(f"x.{either}").isNull() | F.col(f"y.{either}").isNull())
        return x.alias("x").join(y.alias("y"), on).select("x.file", F.col("x.record").alias("record_a"), F.col("y.record").alias("record_b"))

    def without(t: DataFrame, pairs: DataFrame, side: str) -> DataFrame:
        gone = pairs.select(F.col("file").alias("_f"), F.col(side).alias("_r"))
        return t.join(gone, (F.col("file") == F.col("_f")) & (F.col("record") == F.col("_r")), "left_anti")

    pairs = stored(paired(a, b, "hash"), "same_bytes")
    rest_a, rest_b = without(a, pairs, "record_a"), without(b, pairs, "record_b")
    pairs = stored(pairs.unionByName(paired(rest_a, rest_b, "name")), "same_id")
    rest_a, rest_b = without(a, pairs, "record_a"), without(b, pairs, "record_b")

    def anchored(t: DataFrame, side: str) -> DataFrame:
        """Records without a counterpart, with the aligned one before them (by its number in replica A)."""
        known = pairs.select(F.col("file").alias("_f"), F.col(side).alias("_r"), F.col("record_a").alias("anchor"))
        every = t.join(known, (F.col("file") == F.col("_f")) & (F.col("record") == F.col("_r")), "left")
        before = Window.partitionBy("file").orderBy("record").rowsBetween(Window.unboundedPreceding, -1)
        last = F.coalesce(F.last("anchor", ignorenulls=True).over(before), F.lit(-1))
        return every.withColumn("gap", last).filter(F.col("anchor").isNull()).select("file", "record", "gap", "length", "name")

    for key in (("gap", "length"), ("gap",)):
        found = stored(paired(anchored(a, "record_a"), anchored(b, "record_b"), *key, either="name"), "same_gap")
        pairs = pairs.unionByName(found)
    alone_a = without(a, pairs, "record_a").select("file", F.col("record").alias("record_a"), F.lit(None).cast("bigint").alias("record_b"))
    alone_b = without(b, pairs, "record_b").select("file", F.lit(None).cast("bigint").alias("record_a"), F.col("record").alias("record_b"))
    return pairs.unionByName(alone_a).unionByName(alone_b)


def audit(spark: SparkSession, uri_a: str, uri_b: str, fanout: int = FANOUT) -> DataFrame:
    """One row per record of either replica: file, record, offset, length, page_id, sha256 (of replica A, else of B), status.

    status: ok (also where it stands elsewhere in its file), corrupt_b (A is sound, B is not), corrupt_a, missing_b,
    missing_a, or differs (both sound, or neither). Number and place are those of replica A, of B for missing_a.
    """
    a, b = stored(leaves(spark, uri_a), "replica_a"), stored(leaves(spark, uri_b), "replica_b")
    most = max((x.agg(F.max("record")).first()[0] or 0) for x in (a, b))
    depth = 0
    while fanout**depth <= most:
        depth += 1
    bad = compare(tree(a, fanout, depth), tree(b, fanout, depth), fanout).select(F.col("file").alias("_f"), F.col("node").alias("_n"))
    here = (F.col("file") == F.col("_f")) & (F.col("record") == F.col("_n"))
    columns = ("file", "record", "offset", "length", "page_id", F.lower(F.hex("hash")).alias("sha256"))
    sound = a.join(bad, here, "left_anti").select(*columns, F.lit("ok").alias("status"))
    suspects = [stored(t.join(bad, here, "left_semi"), "suspect_records") for t in (a, b)]
    pairs = stored(align(*suspects), "aligned")
    x, y = (t.select(*(F.col(c).alias(f"{c}_{side}") for c in ("file", "record", "offset", "length", "page_id", "hash", "sound"))) for t, side in zip(suspects, "ab", strict=True))
    on = lambda p, side: (F.col("file") == F.col(f"file_{side}")) & (F.col(f"p.record_{side}") == F.col(f"t.record_{side}"))
    both = pairs.alias("p").join(x.alias("t"), on(pairs, "a"), "left").drop(F.col("p.record_a")).alias("p").join(y.alias("t"), on(pairs, "b"), "left").drop(F.col("p.record_b"))
    status = (
        F.when(F.col("hash_a") == F.col("hash_b"), "ok").when(F.col("sound_b").isNull(), "missing_b").when(F.col("sound_a").isNull(), "missing_a")
        .when(F.col("sound_a") & ~F.col("sound_b"), "corrupt_b").when(F.col("sound_b") & ~F.col("sound_a"), "corrupt_a").otherwise("differs")
    )
    pick = lambda c: F.coalesce(f"{c}_a", f"{c}_b")
    told = both.select("file", *(pick(c).alias(c) for c in ("record", "offset", "length", "page_id")), F.lower(F.hex(pick("hash"))).alias("sha256"), status.alias("status"))
    return sound.unionByName(told)
