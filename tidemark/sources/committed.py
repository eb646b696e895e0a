"""Sorted text parts of any size, committed as a whole: a Python data source for writing.

Tasks write their parts into a staging folder beside the target. Only when all are done does the driver name the parts
in order, list them in ``_parts.json``, move what was at the target aside (``path_2``, ``path_3``, ...) and move the
staging folder in. A failed job leaves the target as it was and no staging folder; parts of killed or repeated attempts
are never listed and go with the commit. A driver that dies between the two moves leaves a note beside the target, by
which the next commit or read finishes the work.

The store must be able to move folders (local or network file systems, HDFS), and the path must be one that driver and
executors share.

Cases: nulls are empty cells; equal rows are all kept; an empty table gives one part with the head alone; the order of
rows with equal order columns is that of the other columns; names of columns are free.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidemark.session import ship
from tidemark.sources.readers import line_numbers, text_lines
from tidemark.sources.sinks import fixed, general

LISTED = "_parts.json"


def as_uri(path: str) -> str:
    if path.startswith("file:/"):
        return "file:///" + path[5:].strip("/")
    return path.rstrip("/") if "://" in path else f"file://{Path(path).resolve()}"


def _there(store: fs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type != fs.FileType.NotFound


def _aside(store: fs.FileSystem, path: str) -> str:
    k = 2
    while _there(store, f"{path}_{k}"):
        k += 1
    return f"{path}_{k}"


def _write(store: fs.FileSystem, path: str, value: object) -> None:
    with store.open_output_stream(path) as f:
        f.write((json.dumps(value, indent=2) + "\n").encode())


def recover(path: str) -> None:
    """Finish a commit that its driver did not live to finish; nothing happens where there is none."""
    store, target = fs.FileSystem.from_uri(as_uri(path))
    note = f"{target}.moving"
    if not _there(store, note):
        return
    with store.open_input_stream(note) as f:
        try:
            moving = json.loads(f.read())
        except ValueError:  # the note was not written whole, so nothing was moved
            moving = None
    if moving and _there(store, moving["staging"]):
        if _there(store, target):
            store.move(target, moving["aside"])
        store.move(moving["staging"], target)
    store.delete_file(note)


@dataclass
class Part(WriterCommitMessage):
    task: int
    file: str
    rows: int
    bytes: int
    sha256: str


def _cell(kind: str, digits: int):
    if kind == "text":
        return lambda v: "" if v is None else str(v)
    shown = fixed if kind == "fixed" else general
    return lambda v: "" if v is None else shown(float(v), digits)


class CommittedWriter(DataSourceArrowWriter):
    """``options``: path, head (JSON list of lines), formats (JSON list of [kind, digits] per column)."""

    def __init__(self, options: dict[str, str]):
        self.uri, self.head = as_uri(options["path"]), json.loads(options["head"])
        self.formats = json.loads(options["formats"])
        self.mark = uuid.uuid4().hex

    def _places(self) -> tuple[fs.FileSystem, str, str]:
        store, target = fs.FileSystem.from_uri(self.uri)
        return store, target, f"{target}.staging-{self.mark}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        task = TaskContext.get()
        return self.part(task.partitionId(), task.taskAttemptId(), iterator)

    def part(self, task: int, attempt: int, batches: Iterator[pa.RecordBatch]) -> Part:
        """Write the rows of one task; without rows no file is made."""
        store, _, staging = self._places()
        shown = [_cell(*f) for f in self.formats]
        name, rows, size, digest, out = f"task-{task}-{attempt}", 0, 0, hashlib.sha256(), None
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                lines = [",".join(c) for c in zip(*[map(s, v.to_pylist()) for s, v in zip(shown, batch.columns, strict=True)], strict=True)]
                if out is None:
                    store.create_dir(staging, recursive=True)
                    out = store.open_output_stream(f"{staging}/{name}")
                    lines = self.head + lines
                data = ("\n".join(lines) + "\n").encode()
                out.write(data)
                digest.update(data)
                rows, size = rows + batch.num_rows, size + len(data)
        finally:
            if out is not None:
                out.close()
        return Part(task, name, rows, size, digest.hexdigest())

    def commit(self, messages: list[Part | None]) -> None:
        store, target, staging = self._places()
        recover(self.uri)
        parts = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.task)
        store.create_dir(staging, recursive=True)
        if not parts:
            data = "".join(f"{h}\n" for h in self.head).encode()
            with store.open_output_stream(f"{staging}/task-0") as f:
                f.write(data)
            parts = [Part(0, "task-0", 0, len(data), hashlib.sha256(data).hexdigest())]
        listed = []
        for k, p in enumerate(parts):
            store.move(f"{staging}/{p.file}", f"{staging}/part-{k:05d}.csv")
            listed.append({"name": f"part-{k:05d}.csv", "rows": p.rows, "bytes": p.bytes, "sha256": p.sha256})
        for left in store.get_file_info(fs.FileSelector(staging)):
            if left.base_name.startswith("task-"):
                store.delete_file(left.path)
        _write(store, f"{staging}/{LISTED}", {"head": self.head, "parts": listed})
        _write(store, f"{target}.moving", {"staging": staging, "aside": _aside(store, target)})
        recover(self.uri)

    def abort(self, messages: list[Part | None]) -> None:
        store, _, staging = self._places()
        if _there(store, staging):
            store.delete_dir(staging)


class CommittedText(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidemark_committed"

    def writer(self, schema, overwrite: bool) -> CommittedWriter:
        return CommittedWriter(dict(self.options))


def write_committed(df: DataFrame, path: str, order: list[str], formats: dict[str, tuple[str, int]], head: list[str] | None = None) -> None:
    """The columns of ``formats`` as comma-separated lines sorted by ``order``, in parts that follow one another.

    A format is (text, 0), (fixed, digits) or (general, digits), in C's notation. ``head``: lines before the names of
    the columns; every part has them, so each is a whole file of its kind.
    """
    spark = ship(df.sparkSession)
    spark.dataSource.register(CommittedText)
    # Range partitions over all columns: many rows with equal order columns still go to several tasks.
    keys = [*order, *[c for c in formats if c not in order]]
    rows = df.select(*dict.fromkeys(keys)).repartitionByRange(*keys).sortWithinPartitions(*keys).select(*formats)
    lines = [*(head or []), ",".join(formats)]
    told = {"path": as_uri(path), "head": json.dumps(lines), "formats": json.dumps([list(f) for f in formats.values()])}
    rows.write.format("tidemark_committed").mode("overwrite").options(**told).save()


def committed_parts(path: str) -> dict:
    """What the commit listed: the head, and name, rows, bytes and sha256 of every part in order."""
    recover(path)
    store, target = fs.FileSystem.from_uri(as_uri(path))
    with store.open_input_stream(f"{target}/{LISTED}") as f:
        return json.loads(f.read())


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """Data lines of all parts: part, line (from 1, over all parts in order), value."""
    told, earlier, rows = committed_parts(path), 0, []
    for p in told["parts"]:
        rows.append((p["name"], earlier - len(told["head"])))
        earlier += p["rows"]
    places = F.broadcast(spark.createDataFrame(rows, "part string, _before long"))  # one row per part
    lines, blocks = text_lines(spark, f"{as_uri(path)}/part-*.csv")
    numbered = line_numbers(lines, blocks).filter(F.col("line") > len(told["head"]))
    named = numbered.withColumn("part", F.regexp_extract("file", "[^/]*$", 0)).join(places, "part")
    return named.select("part", (F.col("line") + F.col("_before")).alias("line"), "value")
