"""Committed text parts: order, names, what was there before, failing tasks, drivers that die."""

from __future__ import annotations

import hashlib
import json
import random

import pyarrow as pa
import pytest

from tidemark.sources import committed
from tidemark.sources.sinks import fixed

FORMATS = {"a": ("fixed", 3), "b": ("fixed", 3), "who": ("text", 0), "p": ("general", 6)}


def rows_of(seed, n=500):
    random.seed(seed)
    return [(random.choice([0.0, -0.0001, 0.125, None]), float(random.randrange(4)), random.choice(["x", "y", None]), random.uniform(-1e7, 1e7)) for _ in range(n)]


def table(spark, rows):
    return spark.createDataFrame(rows, "a double, b double, who string, p double").repartition(7)


def content(folder):
    told = json.loads((folder / "_parts.json").read_text())
    names = [p["name"] for p in told["parts"]]
    assert sorted(f.name for f in folder.iterdir() if not f.name.endswith(".crc")) == ["_parts.json", *names]
    assert names == [f"part-{k:05d}.csv" for k in range(len(names))]
    lines = []
    for p in told["parts"]:
        data = (folder / p["name"]).read_bytes()
        assert (hashlib.sha256(data).hexdigest(), len(data)) == (p["sha256"], p["bytes"])
        own = data.decode().splitlines()
        assert own[:2] == ["# plane", "a,b,who,p"] and len(own) == p["rows"] + 2
        lines += own[2:]
    return lines


def brute(rows):
    first = lambda v: (v is not None, 0 if v is None else v)
    ordered = sorted(rows, key=lambda r: (first(r[1]), first(r[0]), first(r[2]) if r[2] else (False, ""), r[3]))
    return [",".join(["" if r[0] is None else fixed(r[0]), fixed(r[1]), r[2] or "", f"{r[3]:.6g}"]) for r in ordered]


def test_sorted_parts_and_the_states_before(spark, tmp_path):
    target = tmp_path / "plane"
    for seed in (1, 2, 3):
        committed.write_committed(table(spark, rows_of(seed)), str(target), ["b", "a"], FORMATS, ["# plane"])
    assert content(target) == brute(rows_of(3)) and content(tmp_path / "plane_2") == brute(rows_of(1)) and content(tmp_path / "plane_3") == brute(rows_of(2))
    assert {f.name for f in tmp_path.iterdir()} == {"plane", "plane_2", "plane_3"}
    got = committed.read_committed(spark, str(target)).orderBy("line").collect()
    assert [(r["line"], r["value"]) for r in got] == list(enumerate(brute(rows_of(3)), 1))


def test_a_failing_task_leaves_the_old_state(spark, tmp_path):
    target = tmp_path / "plane"
    committed.write_committed(table(spark, rows_of(1)), str(target), ["b", "a"], FORMATS, ["# plane"])
    # A cell that is no number fails in the writer of one task, while the parts of the others are written.
    bad = table(spark, [(r[0], r[1], "7" if k else "x", r[3]) for k, r in enumerate(rows_of(2))])
    with pytest.raises(Exception, match="could not convert"):
        committed.write_committed(bad, str(target), ["b", "a"], FORMATS | {"who": ("fixed", 1)}, ["# plane"])
    assert {f.name for f in tmp_path.iterdir()} == {"plane"} and content(target) == brute(rows_of(1))


def writer(target):
    return committed.CommittedWriter({"path": str(target), "head": '["# plane", "a,b,who,p"]', "formats": json.dumps([list(f) for f in FORMATS.values()])})


def batch(rows):
    return pa.RecordBatch.from_pylist([dict(zip(FORMATS, r, strict=True)) for r in rows], pa.schema([("a", pa.float64()), ("b", pa.float64()), ("who", pa.string()), ("p", pa.float64())]))


def test_repeated_and_killed_attempts_are_not_listed(tmp_path):
    w = writer(tmp_path / "plane")
    killed = w.part(1, 11, iter([batch([(1.0, 1.0, "killed", 1.0)])]))
    parts = [w.part(1, 12, iter([batch([(1.0, 1.0, "b", 1.0)])])), w.part(0, 10, iter([batch([(0.5, 0.0, "a", 2.0)]), batch([])])), w.part(2, 13, iter([]))]
    assert killed.rows == 1
    w.commit([parts[0], None, parts[2], parts[1]])
    assert content(tmp_path / "plane") == ["0.500,0.000,a,2", "1.000,1.000,b,1"]
    again = writer(tmp_path / "plane")
    again.abort([again.part(0, 1, iter([batch([(1.0, 1.0, "x", 1.0)])]))])
    assert {f.name for f in tmp_path.iterdir()} == {"plane"}


@pytest.mark.parametrize("died_after", ["note", "first move", "both moves", "half a note"])
def test_a_commit_is_finished_after_its_driver_died(tmp_path, died_after):
    target, aside, staging, note = (tmp_path / n for n in ("plane", "plane_2", "plane.staging-1", "plane.moving"))
    old, new = (target, staging) if died_after in ("note", "half a note") else (aside, staging) if died_after == "first move" else (aside, target)
    for folder, name in ((old, "old"), (new, "new")):
        folder.mkdir()
        (folder / name).touch()
    text = json.dumps({"staging": str(staging), "aside": str(aside)})
    note.write_text(text[:9] if died_after == "half a note" else text)
    committed.recover(str(target))
    assert not note.exists()
    assert [f.name for f in target.iterdir()] == (["old"] if died_after == "half a note" else ["new"])
    assert died_after == "half a note" or [f.name for f in aside.iterdir()] == ["old"]


def test_an_empty_table(spark, tmp_path):
    committed.write_committed(table(spark, []), str(tmp_path / "plane"), ["b", "a"], FORMATS, ["# plane"])
    assert content(tmp_path / "plane") == [] and committed.read_committed(spark, str(tmp_path / "plane")).count() == 0
