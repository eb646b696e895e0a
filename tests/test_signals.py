"""Signals on analytic input: periods, trapezoid, phases, spectrum."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import signals

F0 = 0.165


@pytest.fixture(scope="module")
def shedding(spark):
    rows = [("a", 0.05 * i, 0.05 + 0.33 * math.sin(2 * math.pi * F0 * 0.05 * i)) for i in range(3000)]
    s = spark.createDataFrame(rows, "run string, t double, y double").cache()
    about = signals.about_mean(s, ["run"])
    return s, about, signals.upward_crossings(about, ["run"])


def test_period_window(shedding):
    p = signals.period_window(shedding[2], ["run"]).first()
    assert p["frequency"] == pytest.approx(F0, rel=1e-3) and p["periods"] in (23, 24)


def test_trapezoid_of_a_sine(shedding):
    s, _, c = shedding
    span = c.groupBy("run").agg(F.lit("w").alias("half"), F.min("t_cross").alias("a"), F.max("t_cross").alias("b"))
    r = signals.trapezoid_stats(s, span, ["run"], ["half"]).first()
    assert r["time_mean"] == pytest.approx(0.05, abs=1e-3) and r["time_rms"] == pytest.approx(0.33 / math.sqrt(2), rel=1e-3)


def test_amplitude_and_halves(shedding):
    s, about, c = shedding
    assert signals.peak_to_peak(about, c, ["run"]).first()["amplitude"] == pytest.approx(0.33, rel=2e-3)
    assert signals.halves_test(s, c, ["run"], tolerance=1e-2).first()["passed"]


def test_phase_average(shedding):
    s, _, c = shedding
    rows = {r["phase_no"]: r for r in signals.phase_average(s, c, ["run"], 32, 0.2).collect()}
    for j, r in rows.items():
        assert r["mean"] == pytest.approx(0.05 + 0.33 * math.sin(2 * math.pi * j / 32), abs=4e-3) and r["sd"] < 4e-3


def test_spectrum_sums_to_the_variance(spark):
    n = 64
    y = [math.sin(2 * math.pi * 5 * i / n) + 0.5 * math.cos(math.pi * i) + 0.1 * (i % 7) for i in range(n)]
    even = spark.createDataFrame([("a", i, float(i), v) for i, v in enumerate(y)], "run string, i long, t double, y double")
    rows = {r["bin"]: r["power"] for r in signals.spectrum(even, ["run"], n // 2).collect()}
    mean = sum(y) / n
    assert sum(rows.values()) == pytest.approx(sum((v - mean) ** 2 for v in y) / n, rel=1e-9)
    assert rows[5] == pytest.approx(0.5, rel=0.05) and rows[n // 2] == pytest.approx(0.25, rel=0.05)


def test_interpolation_clamps_outside(spark):
    s = spark.createDataFrame([("a", 0.0, 1.0), ("a", 1.0, 3.0), ("a", 4.0, 0.0)], "run string, t double, y double")
    q = spark.createDataFrame([("a", x) for x in (-1.0, 0.0, 0.5, 1.0, 2.5, 4.0, 9.0)], "run string, tq double")
    got = {r["tq"]: r["yq"] for r in signals.interp_at(s, q, ["run"], 0.7).collect()}
    assert got == pytest.approx({-1.0: 1.0, 0.0: 1.0, 0.5: 2.0, 1.0: 3.0, 2.5: 1.5, 4.0: 0.0, 9.0: 0.0})


def test_lowpass_keeps_the_slow_part(spark):
    rows = [("a", float(i), math.sin(2 * math.pi * i / 200) + 0.5 * math.sin(2 * math.pi * i / 5)) for i in range(1000)]
    out = signals.fft_lowpass(spark.createDataFrame(rows, "run string, t double, y double"), ["run"], 50.0).filter("t between 300 and 700").collect()
    assert max(abs(r["smooth"] - math.sin(2 * math.pi * r["t"] / 200)) for r in out) < 0.02


def test_reconstruction_and_lag(spark):
    m = spark.createDataFrame([(s, j, math.cos(2 * math.pi * (j - d) / 16)) for s, d in (("u", 0), ("v", 4)) for j in range(16)], "signal string, phase_no int, mean double")
    lag = {r["signal"]: r["lag"] for r in signals.phase_lag(m, [], "signal", "u", 16).collect()}
    assert lag == pytest.approx({"u": 0.0, "v": 0.25})
    q = spark.createDataFrame([("u", 0.0, 10.0, 2, 2.5)], "signal string, a double, b double, periods int, tq double")
    assert signals.reconstruct_at(m, q, ["signal"], 16).first()["yq"] == pytest.approx(-1.0)


@pytest.mark.parametrize("samples", [7, 300, 100_000])
def test_series_of_one_two_and_many_buckets(spark, monkeypatch, samples):
    """Crossings, cycles, segments, resampling and moving means over buckets equal the plain loop; gaps leave empty buckets."""
    monkeypatch.setattr("tidemark.operators.ordered.SAMPLES", samples)
    monkeypatch.setattr(signals, "SAMPLES", samples)
    times = [0.1 * i for i in range(150)] + [60 + 0.1 * i for i in range(150)]
    y = [math.sin(2.1 * t) + 0.3 * math.sin(7.7 * t) for t in times]
    rows = [("a", t, v) for t, v in zip(times, y, strict=True)] + [("b", 3.0, 1.0), ("c", 1.0, -1.0), ("c", 1.0 + 1e-9, 1.0)]
    s = spark.createDataFrame(rows, "run string, t double, y double").repartition(5)
    c = signals.upward_crossings(s, ["run"])
    want = [t0 + (t1 - t0) * -y0 / (y1 - y0) for t0, t1, y0, y1 in zip(times, times[1:], y, y[1:], strict=False) if y0 < 0 <= y1]
    got = {run: [r["t_cross"] for r in c.filter(F.col("run") == run).orderBy("k").collect()] for run in "abc"}
    assert got["a"] == want and got["b"] == [] and len(got["c"]) == 1
    assert [r["k"] for r in c.filter("run = 'a'").orderBy("t_cross").collect()] == list(range(len(want)))
    seg = {r["t"]: (r["t1"], r["y1"]) for r in signals.segments(s, ["run"]).filter("run = 'a'").collect()}
    assert seg == {t0: (t1, y1) for t0, t1, y1 in zip(times, times[1:], y[1:], strict=False)}
    cycles = {r["t"]: r["cycle"] for r in signals.cycles_of(s, c, ["run"]).collect()}
    assert cycles == {t: sum(x <= t for x in want) - 1 for t in times if want[0] <= t < want[-1]}
    for width in (1, 4, 9, 400):
        smooth = {r["t"]: r["smooth"] for r in signals.moving_mean(s, ["run"], width).filter("run = 'a'").collect()}
        padded = [0.0] * 500 + y + [0.0] * 500
        assert [smooth[t] for t in times] == pytest.approx([sum(padded[500 + i - width // 2 : 500 + i - width // 2 + width]) / width for i in range(len(y))], abs=1e-9)


def test_padded_hann_spectrum_equals_numpy(spark):
    n, pad = 90, 8
    y = [math.sin(2 * math.pi * 7.3 * i / n) + 0.2 * math.cos(i) + 3 for i in range(n)]
    even = spark.createDataFrame([("r", i, v) for i, v in enumerate(y)], "run string, i long, y double")
    got = {r["bin"]: r["power"] for r in signals.hann_spectrum(even, ["run"], 10_000, padding=pad).collect()}
    power = np.abs(np.fft.rfft((np.array(y) - np.mean(y)) * np.hanning(n), n * pad))[1:] ** 2
    power[:-1] *= 2  # one-sided, all but the last bin
    assert sorted(got) == list(range(1, n * pad // 2 + 1))
    assert [got[b] for b in sorted(got)] == pytest.approx(list(power / power.max()), abs=1e-9)
    assert max(got, key=got.get) == round(7.3 * pad)  # without padding the peak would be told as 7
