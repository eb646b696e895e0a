"""Windows and the gate: analytic cases, and batch = streaming = plain Python."""

from __future__ import annotations

import math
import random
import time

import pytest

from tidemark.operators import windows
from tidemark.streaming import gate


def history(spark, series):
    rows = [(run, i, float(v)) for run, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "run string, i long, value double")


def noisy(mean, sd, n, seed):
    rng = random.Random(seed)
    return [mean + sd * math.sin(0.9 * i) + rng.gauss(0, sd / 10) for i in range(n)]


CASES = {
    "steady": noisy(1.0, 0.2, 400, 1),
    "drifting": [v + i / 100 for i, v in enumerate(noisy(1.0, 0.2, 1400, 2))],
    "flat": [2.0 + 1e-6 * math.sin(i) for i in range(400)],
}


def verdicts(spark, series, size=200):
    h = history(spark, series)
    stats = windows.schmitt_cycles(h, windows.window_stats(h, size, ["run"]), size, ["run"])
    return h, stats, windows.stop_decision(stats, windows.stationarity_gate(stats, ["run"]), ["run"], [], size)


def test_verdicts(spark):
    _, _, d = verdicts(spark, CASES)
    got = {r["run"]: (r["status"], r["window"]) for r in d.collect()}
    assert got == {"steady": ("stationary", 1), "drifting": ("no_steady_state", 6), "flat": ("converged", 0)}


def test_batch_equals_python(spark):
    _, stats, _ = verdicts(spark, CASES)
    for r in stats.collect():
        values = CASES[r["run"]][200 * r["window"] : 200 * r["window"] + 200]
        mean, sd, cycles = gate.window_of(values)
        assert r["mean"] == pytest.approx(mean, rel=1e-9) and r["sd"] == pytest.approx(sd, rel=1e-9) and r["cycles"] == cycles


def test_streaming_equals_batch(spark, tmp_path):
    h, _, d = verdicts(spark, CASES)
    h.repartition(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(h.schema).parquet(str(tmp_path / "in"))
    q = gate.streaming_gate(stream, 200).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    last = {r["run"]: (r["status"], r["window"]) for r in spark.read.parquet(str(tmp_path / "out")).filter("status <> 'running'").collect()}
    assert last == {r["run"]: (r["status"], r["window"]) for r in d.collect()}


def test_short_window_is_left_out(spark):
    h = history(spark, {"a": [1.0] * 250})
    assert [r["window"] for r in windows.window_stats(h, 200, ["run"]).collect()] == [0]


def test_divergence_comes_first(spark):
    series = CASES["steady"][:50] + [math.nan] + CASES["steady"][51:]
    h = history(spark, {"a": series})
    off = windows.first_offender(h, ["run"], h["value"].isNull() | (h["value"] != h["value"]) | h["value"].cast("string").isin("NaN"))
    stats = windows.schmitt_cycles(h, windows.window_stats(h, 200, ["run"]), 200, ["run"])
    d = windows.stop_decision(stats, windows.stationarity_gate(stats, ["run"]), ["run"], [], 200, off).first()
    assert (d["status"], d["stopped_at"]) == ("diverged", 50)


def test_hysteresis_ignores_the_first_excursion():
    assert gate.window_of([1.0, -1.0] * 10)[2] == 9  # 19 crossings
    assert gate.window_of([0.0] * 5 + [1.0] * 5)[2] == 0


def test_signals_gate_live_equals_replay(spark, tmp_path):
    """Four signals in micro-batches out of order, with repeats, over a restart: the verdicts of the batch; a run that ends early is told."""
    rng = random.Random(9)
    wave = lambda k, drift=0.0: [math.sin(0.5 * i + k) + rng.gauss(0, 0.1) + drift * i for i in range(1600)]
    runs = {"steady": [wave(k) for k in range(4)], "one drifts": [*[wave(k) for k in range(3)], wave(3, 0.01)], "flat": [[2.0] * 1600] * 4, "short": [wave(0), wave(1), wave(2), wave(3)[:300]]}
    rows = [(r, f"s{k}", i, v) for r, signals in runs.items() for k, values in enumerate(signals) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "run string, signal string, i long, value double")
    stats = windows.schmitt_cycles(df, windows.window_stats(df, 200, ["run", "signal"]), 200, ["run", "signal"])
    batch = windows.stop_decision(stats, windows.stationarity_gate(stats, ["run", "signal"]), ["run"], ["signal"], 200).filter("run <> 'short'")
    want = {r["run"]: (r["status"], r["window"], r["stopped_at"]) for r in batch.collect()}
    assert {r: w[0] for r, w in want.items()} == {"steady": "stationary", "one drifts": "no_steady_state", "flat": "converged"}
    rng.shuffle(rows)
    parts = [rows[k::4] for k in range(4)]
    parts[2] += parts[0][:500] + [("steady", "other", 0, 9.0), ("steady", "s0", 0, None)]
    before = spark.conf.get(gate.STORE[0])
    spark.conf.set(*gate.STORE)
    try:
        for done in (2, 4):  # stopped after two micro-batches, and started again from its checkpoint
            for k in range(done - 2, done):
                spark.createDataFrame(parts[k], df.schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
            out = gate.signals_gate(stream, 200, ["s0", "s1", "s2", "s3"])
            sink = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state"))
            sink.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(gate.STORE[0], before)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r["run"]: (r["status"], r["window"], r["at"]) for r in got if r["status"] != "running"} == want
    assert sorted(r["window"] for r in got if r["run"] == "short") == [0] and len(got) == len({(r["run"], r["window"]) for r in got})


def test_an_idle_run_is_unfinished(spark, tmp_path):
    df = spark.createDataFrame([("a", "s", i, float(i % 7)) for i in range(30)], "run string, signal string, i long, value double")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    before = spark.conf.get(gate.STORE[0])
    spark.conf.set(*gate.STORE)
    try:
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        q = gate.signals_gate(stream, 20, ["s"], idle_ms=500).writeStream.format("memory").queryName("idle_runs").option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(processingTime="1 second").start()
        end = time.time() + 60
        while time.time() < end and not spark.table("idle_runs").filter("status = 'unfinished'").count():
            time.sleep(1)
        q.stop()
    finally:
        spark.conf.set(gate.STORE[0], before)
    assert sorted(tuple(r) for r in spark.table("idle_runs").collect()) == [("a", 0, 19, "running"), ("a", 1, 19, "unfinished")]
