"""Whole flows, accounts and the command line."""

from __future__ import annotations

import json
import math

import pytest
from pyspark.sql import functions as F

from tidemark.__main__ import main
from tidemark.operators import accounts
from tidemark.plans import flow


def test_guard_finds_the_changed_statistic(spark):
    rows = [("r", s, i, math.sin(0.7 * i + k) + k) for k, s in enumerate(("cd", "cl")) for i in range(600)]
    out = flow.replay(spark.createDataFrame(rows, "run string, signal string, i long, value double"), 200, ["run"], ["signal"])
    published = out["published"]
    assert {r["status"] for r in out["decision"].collect()} == {"stationary"} and published.count() == 2
    declared = published.withColumn("sd", F.when(F.col("signal") == "cl", F.col("sd") * 1.01).otherwise(F.col("sd")))
    assert [(r["signal"], r["column"]) for r in flow.guard(published, declared, ["run", "signal"], ["published", "sd"]).collect()] == [("cl", "sd")]


def test_flow_summary(spark):
    rows = [(s, 0.05 * i, a + b * math.sin(2 * math.pi * 0.165 * k * 0.05 * i)) for s, a, b, k in (("cl", 0.05, 0.33, 1), ("cd", 1.3, 0.01, 2)) for i in range(4000)]
    got = {r["signal"]: r for r in flow.flow_summary(spark.createDataFrame(rows, "signal string, t double, y double"), [], "cl", 50.0, 190.0).collect()}
    assert got["cl"]["frequency"] == pytest.approx(0.165, rel=1e-3) and got["cl"]["amplitude"] == pytest.approx(0.33, rel=5e-3)
    assert got["cd"]["time_mean"] == pytest.approx(1.3, abs=1e-4) and got["cd"]["time_rms"] == pytest.approx(0.01 / math.sqrt(2), rel=1e-2)


def test_sweep_goes_on_after_a_failure():
    out = flow.sweep(["1", "x", "3"], int)
    assert [(o.result, o.error is None) for o in out] == [(1, True), (None, False), (3, True)]


def test_sets_and_contracts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "y"), ("b", "z")], "g string, m string")
    assert tuple(accounts.key_sets(df, "g", "m", ("a", "b")).first()) == (["x"], ["z"], ["y"])
    a = spark.createDataFrame([(1, '{"p": 1, "q": [2]}'), (2, "{}")], "k int, c string")
    b = spark.createDataFrame([(1, '{"q": [2], "p": 1}'), (3, "{}")], "k int, c string")
    assert {r["k"]: r["equal"] for r in accounts.contract_equal(a, b, ["k"], "c").collect()} == {1: True, 2: False, 3: False}
    one = spark.createDataFrame([(2.0,)], "v double")
    assert accounts.two_route_check(one, one.select((F.col("v") * 2).alias("v")), "v").first()["difference"] == 0.5
    frame = spark.createDataFrame([(2, [0, 0, 0, 255, 0, 1])], "width int, pixels array<int>")
    assert not accounts.corners_masked(frame, (0, 0, 0)).first()["masked"]


def test_command_line_without_spark(tmp_path, capsys):
    (tmp_path / "s.txt").write_text("A\n  B\n  C\n")
    assert main(["setup", "encode", str(tmp_path / "s.txt"), "--write", str(tmp_path / "c.txt")]) == 0
    assert main(["setup", "decode", str(tmp_path / "c.txt")]) == 0 and capsys.readouterr().out == "A\n  B\n  C\n"
    (tmp_path / "d.json").write_text('{"a": 1.50}')
    (tmp_path / "e.json").write_text(json.dumps([["rename", "a", "b"]]))
    assert main(["migrate", str(tmp_path / "d.json"), str(tmp_path / "e.json"), "--write"]) == 0
    assert (tmp_path / "d.json").read_text() == '{\n  "b": 1.50\n}\n'
