"""Readers, reports, copies, sweeps, commands, the moving stop as a stream, and the feature flow."""

from __future__ import annotations

import json
import math
import random

import numpy as np
import pytest

from tidemark import __main__ as cli
from tidemark.functions import expr
from tidemark.operators import features, migrate, text, windows
from tidemark.plans import flow
from tidemark.sources import readers, sinks
from tidemark.streaming import gate


def test_small_readers(spark, tmp_path):
    (tmp_path / "n.csv").write_text("cells\n1234.5\n")
    (tmp_path / "bad.csv").write_text("cells,more\n1,2\n")
    assert {r["file"]: r["cells"] for r in readers.read_cells(spark, str(tmp_path)).collect()} == {"n.csv": 1234, "bad.csv": None}
    (tmp_path / "m").write_text('"Iteration","Physical Time (s)","cd Monitor: cd"\n1,0.5,2.0\n2,1.0,2.5\n')
    assert [tuple(r) for r in readers.read_monitor_export(spark, str(tmp_path / "m")).orderBy("t").collect()] == [(0.5, 2.0), (1.0, 2.5)]
    (tmp_path / "two").write_text("Time A,Time B\n1,2\n")
    with pytest.raises(readers.ColumnError):
        readers.read_monitor_export(spark, str(tmp_path / "two"))
    (tmp_path / "named").write_text("b,a,c\n1,x,2.5\n")
    assert [tuple(r) for r in readers.read_named_csv(spark, str(tmp_path / "named"), {"c": "double", "a": "string"}).collect()] == [(2.5, "x")]
    with pytest.raises(readers.ColumnError):
        readers.read_named_csv(spark, str(tmp_path / "named"), {"z": "int"})
    df = spark.createDataFrame([(1, 2, 3)], "`X (m)` int, `Y (m)` int, note int")
    assert readers.project_named(df, {"y": "Y", "x": "X"}).columns == ["y", "x"]


def test_signals_must_have_two_columns(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "cd.csv").write_text(f"tU_D,cd\n0,{1 if folder == 'a' else 2}\n")
    (tmp_path / "a" / "three.csv").write_text("tU_D,cd,cl\n0,1,2\n")
    got = readers.read_signals(spark, str(tmp_path / "*")).collect()
    assert sorted((r["signal"], r["y"], r["line"]) for r in got) == [("cd", 1.0, 2), ("cd", 2.0, 2)] and len({r["folder"] for r in got}) == 2
    with pytest.raises(readers.ColumnError, match="three"):
        readers.read_signals(spark, str(tmp_path / "*"), strict=True)


SWEEP = {"points": [100, 300], "regime_ref": "book", "declared": {"300": {"regime_expected": "steady", "uncertainty": {"a": 1}}}, "designed_for_Re_range": [100, 300]}


@pytest.mark.parametrize("change", [{"points": []}, {"points": [1, 1]}, {"points": [1.5]}, {"points": "x"}, {"more": 1}, {"declared": {"7": {}}}, {"declared": {"300": {"x": 1}}}, {"declared": {"300": {"regime_expected": 1}}}, {"designed_for_Re_range": [3, 1]}, {"regime_ref": 5}])
def test_sweep_file(change):
    assert readers.read_sweep(json.dumps(SWEEP)) == SWEEP
    with pytest.raises(ValueError):
        readers.read_sweep(json.dumps(SWEEP | change))


def test_reports(spark):
    df = spark.createDataFrame([("a|b", 1.5, 10), ("c", None, 2)], "name string, x double, n long").orderBy("n")
    assert sinks.report_text(df) == "name    x   n\nc           2\na|b   1.5  10\n"
    assert sinks.report_markdown(df, "T").splitlines() == ["## T", "", "| name | x | n |", "|---|---|---|", "| c |  | 2 |", "| a\\|b | 1.5 | 10 |"]
    assert json.loads(sinks.report_json(df)) == [{"name": "c", "x": None, "n": 2}, {"name": "a|b", "x": 1.5, "n": 10}]


def test_whitelist_copy(tmp_path):
    source, target = tmp_path / "s", tmp_path / "t"
    (source / "views").mkdir(parents=True)
    for n in ("a.json", "views/v.png", "secret.txt"):
        (source / n).write_text(n)
    for _ in range(2):
        assert sinks.whitelist_copy(str(source), str(target), [r"a\.json", r"views/.*"]) == ["a.json", "views/v.png"]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["s", "t", "t_2"] and not (target / "secret.txt").exists()
    with pytest.raises(FileNotFoundError):
        sinks.whitelist_copy(str(source), str(target), ["gone"])


def test_build_sweep_goes_on_after_a_failure(spark, tmp_path):
    good = tmp_path / "src"
    good.mkdir()
    (good / "setup.txt").write_text("Node\n")
    (good / "summary.json").write_text('{"reference": {"length_m": 1.0}}')
    out = flow.build_sweep(spark, {"capsule_a": str(good), "capsule_b": str(tmp_path / "none")}, str(tmp_path / "out"), [r".*\.(txt|json)"])
    assert out[0].result["status"] == "FAIL" and out[0].result["errors"] == 0 and out[0].result["tokens"] == 9  # no environment: a warning, which strict fails
    assert out[1].error and (tmp_path / "out" / "capsule_a.zip").exists()


def test_build_sweep_compares_with_the_base_and_settles_tokens(spark, tmp_path):
    points = {}
    for name, cd in (("capsule_a", 2.0), ("capsule_b", 2.5), ("capsule_c", 0.0)):
        points[name] = str(tmp_path / "src" / name)
        (tmp_path / "src" / name).mkdir(parents=True)
        (tmp_path / "src" / name / "setup.txt").write_text("Node\n" * 30)
        (tmp_path / "src" / name / "summary.json").write_text(json.dumps({"forces": {"cd": cd, f"only_{name}": 1}, "note": "n", "list": [1, cd]}))
        (tmp_path / "src" / name / "manifest.json").write_text('{"planes": []}')
    (tmp_path / "src" / "capsule_c" / "setup.txt").unlink()
    build = lambda base, chosen: {o.point: o for o in flow.build_sweep(spark, chosen, str(tmp_path / "out"), [r"setup\.txt", r".*\.json"], base=base, contract={"base": {"commit": "c" * 40}})}
    out = build("capsule_a", points)
    assert "declared but not there" in out["capsule_c"].error and "no difference" not in str(out["capsule_b"].result["blockers"])
    told = json.loads((tmp_path / "out/capsule_b/diff.json").read_text())
    change = {"base": 2.0, "variant": 2.5, "delta": 0.5, "relative": 0.25}
    assert told["base"] == {"capsule": "capsule_a", "commit": "c" * 40} and not (tmp_path / "out/capsule_a/diff.json").exists()
    assert sorted(told["scalar_deltas"].values(), key=lambda d: d["base"]) == [{"base": 1.0, "variant": 1.0, "delta": 0.0, "relative": 0.0}, change, change]
    rates = {"setup.txt": 3.5, "summary.json": 4.0, "manifest.json": 4.0, "diff.json": 4.0}
    for name in ("capsule_a", "capsule_b"):
        folder = tmp_path / "out" / name
        total = sum(round(len(f.read_text()) / rates[f.name]) for f in folder.iterdir())
        held = json.loads((folder / "manifest.json").read_text())
        assert held["tokens"]["total"] == total == out[name].result["tokens"] and list(held) == ["planes", "tokens"]
    alone = build("capsule_c", {"capsule_a": points["capsule_a"]})
    assert "no difference: capsule_c is not built" in alone["capsule_a"].result["blockers"]
    earlier = build("capsule_b", {"capsule_a": points["capsule_a"]})  # the base lies there from an earlier sweep
    assert "no difference" not in str(earlier["capsule_a"].result["blockers"]) and (tmp_path / "out/capsule_a/diff.json").exists()


def test_moving_stop_as_a_stream(spark, tmp_path):
    rng = random.Random(3)
    rows = [(run, i, math.cos(a) + rng.gauss(0, 0.01), math.sin(a) + rng.gauss(0, 0.01)) for run, speed in (("turns", 0.05), ("stays", 0.0)) for i in range(120) for a in [speed * i]]
    df = spark.createDataFrame(rows, "run string, i long, across double, up double")
    batch = {r["run"]: (r["reason"], r["stopped_at"], r["angle"]) for r in windows.moving_stop(df, ["run"], "i", "across", "up", 90.0).collect()}
    assert batch["stays"][:2] == ("end", 119) and batch["turns"][0] == "angle"
    df.repartition(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = gate.streaming_moving_stop(stream, 90.0).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(got) == 1 and got[0][:2] == ("turns", batch["turns"][1]) and got[0][2] == pytest.approx(batch["turns"][2])


def test_points_on_an_edge_are_clustered_in_each_station(spark):
    rows = [(0, 0.0, 0.0), (1, 1.0, 0.1), (2, 2.0, 0.2)]  # node 1 lies in both stations and must not chain them
    df = spark.createDataFrame([(n, x, y, 0.0, 1.0, 1.0) for n, x, y in rows], "node long, x double, y double, z double, volume double, q double")
    got = features.clustered(features.station_bin(df, [0.5, 1.5], 1.0), ["station"], "node", "y", "z", "volume", 2.0).collect()
    assert sorted((r["station"], r["node"], r["cluster"]) for r in got) == [(0.5, 0, 0), (0.5, 1, 0), (1.5, 1, 1), (1.5, 2, 1)]


def test_feature_flow(spark):
    rng = np.random.default_rng(4)
    rows = [(i, 0.5, s * 1.0 + rng.normal(0, 0.01), 0.5 + rng.normal(0, 0.01), 1e-6, 10.0, float(s)) for i, s in enumerate([1, -1] * 30)] + [(99, 0.5, 0.0, -5.0, 1e-6, 1e9, 1.0)]
    cloud = spark.createDataFrame(rows, "node long, x double, y double, z double, volume double, q double, wx double")
    got = flow.feature_flow(cloud, [0.5], 0.2, 0.0, 0.5, 10.0).collect()
    assert sorted(r["sense"] for r in got) == [-1, 1]  # the peak below the cut does not raise the threshold


def test_template_numbers():
    assert text._fill("{007:1}", 1) == "008" and text._fill("{2.50:0.25}", 2) == "3.0" and text._fill("{-1:1}", 0) == "-1" and text._fill("{1:-1}", 3) == "-2"
    plain = "\n".join(["A"] + [f"  Probe 0{k:02d}" for k in range(5)] + [f"  Value {v}" for v in (0.5, 1.0, 1.5, 2.0)]) + "\n"
    assert text.decode(text.encode(plain)) == plain


def test_edits_by_kind():
    doc = '{"a": {"v": {"value": 1.50, "note": "n", "unit_flag": "m"}}, "b": {}, "k": 5}'
    new, r = migrate.migrate(doc, [("ensure", "b"), ("ensure", "c"), ("set", "k", 6), ("set", "new", 7), ("expand", "a/v", "v_m", "v_note"), ("move", "k", "c", "key")])
    assert json.loads(new) == {"a": {"v_m": 1.5, "v_note": "n"}, "b": {}, "c": {"key": 5}, "new": 7} and "1.50" in new
    assert r.already == ["ensure b", "set k"]
    again, second = migrate.migrate(new, [("ensure", "c"), ("expand", "a/v", "v_m", "v_note"), ("move", "k", "c", "key")])
    assert again == new and not second.changed
    for bad in [("expand", "a/v", "v_m"), ("expand", "k", "z"), ("move", "zz", "b"), ("move", "k", "zz"), ("ensure", "zz/y")]:
        assert migrate.migrate(doc, [bad])[0] is None


def test_expressions_of_keys_and_arrays(spark):
    df = spark.createDataFrame([([1.0, 2.0], '{"a": {"b": 3}}'), ([2.0, None], "no"), ([], "{}")], "v array<double>, j string")
    rows = df.select(expr.is_pair("v").alias("pair"), expr.array_shape("v").alias("s"), expr.json_get("j", "$.a.b", "int", -1).alias("b")).collect()
    assert [r["pair"] for r in rows] == [True, False, False] and [tuple(r["s"]) for r in rows] == [(2, 0, True), (2, 1, False), (0, 0, False)] and [r["b"] for r in rows] == [3, -1, -1]


def test_commands(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "local_session", lambda: spark)
    monkeypatch.setattr(cli, "_session", lambda: spark)
    root = tmp_path / "root" / "capsule_x"
    root.mkdir(parents=True)
    (root / "setup.txt").write_text("Node\n")
    (root / "summary.json").write_text('{"reference": {"length_m": 1.0}}')
    assert cli.main(["validate", str(tmp_path / "root")]) == 0 and "WARN" in capsys.readouterr().out
    assert cli.main(["validate", str(tmp_path / "root"), "--strict", "--format", "json"]) == 1
    capsys.readouterr()
    assert cli.main(["ledger", str(tmp_path / "root"), "--format", "markdown"]) == 0 and "setup.txt" in capsys.readouterr().out
    (tmp_path / "sweep.json").write_text(json.dumps(SWEEP))
    assert cli.main(["guard", str(tmp_path / "root"), str(tmp_path / "sweep.json")]) == 1 and "G01" in capsys.readouterr().out
    rows = [f"{x},{y},{z},0.001,{x * x},{s}" for k, (x, y, z) in enumerate((i / 10, j / 10 + 0.05, l / 10) for i in range(4) for j in range(-4, 4) for l in range(4)) for s in [1 if y > 0 else -1]]
    (tmp_path / "c.csv").write_text("\n".join(["X (m),Y (m),Z (m),Volume (m^3),Q,Vorticity", *rows]) + "\n")
    assert cli.main(["mirror", str(tmp_path / "c.csv")]) == 0 and "128" in capsys.readouterr().out
    assert cli.main(["sample", str(tmp_path / "c.csv"), "Q", "--keep", "5"]) == 0 and len(capsys.readouterr().out.splitlines()) == 6
    assert cli.main(["features", str(tmp_path / "c.csv"), "--stations", "0.3", "--vorticity", "Vorticity"]) == 0 and len(capsys.readouterr().out.splitlines()) == 3
    (tmp_path / "sig").mkdir()
    (tmp_path / "sig" / "cl.csv").write_text("tU_D,cl\n" + "".join(f"{i / 10},{math.sin(i / 10)}\n" for i in range(1, 2000)))
    assert cli.main(["signals", str(tmp_path / "sig"), "--start", "10", "--end", "150"]) == 0 and "cl" in capsys.readouterr().out
    assert cli.main(["extract", str(root), str(tmp_path / "out"), r".*\.json", "--write"]) == 0 and (tmp_path / "out" / "summary.json").exists()
    from tidemark.sources import images

    for side, level in (("a", 10), ("b", 14)):
        (tmp_path / side / "capsule_x").mkdir(parents=True)
        (tmp_path / side / "capsule_x" / "v.png").write_bytes(images.encode_png(np.full((4, 4, 3), level)))
    capsys.readouterr()
    assert cli.main(["diff", str(tmp_path / "a"), str(tmp_path / "b"), "--threshold", "3"]) == 0 and "capsule_x/v.png" in capsys.readouterr().out


def test_rejects_have_their_lines_over_blocks(spark, tmp_path):
    """Files of many blocks, with blank lines, a repeated header, quotes, short rows and another header: lines as counted by reading the file whole."""
    files = {}
    for f in ("a.csv", "b.csv"):
        lines = ["", "X (m), Note ,Volume (m^3)"]
        for k in range(900):
            lines.append({0: "", 1: f"{k},x,-1", 2: f"{k},\"a, b\",nan", 3: f"{k}", 4: "X (m), Note ,Volume (m^3)"}.get(k % 37, f"{k},\"p, q\",{k + 1}.5"))
        files[f] = lines
    files["c.csv"] = ["Volume (m^3),X (m)", "1,2,3"]
    for f, lines in files.items():
        (tmp_path / f).write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        blocks = readers.text_lines(spark, str(tmp_path))[1].count()
        rows, rejects = readers.read_csv_strict(spark, str(tmp_path), {"x": "X", "volume": "Volume"}, positive=("volume",))
        good, bad = rows.count(), sorted((r["file"].rsplit("/", 1)[1], r["line"], r["reason"]) for r in rejects.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    why = {1: "volume is not positive", 2: "volume is not a finite number", 3: "volume is not a finite number"}
    want = [(f, k + 3, why[k % 37]) for f in ("a.csv", "b.csv") for k in range(900) if k % 37 in why]
    assert blocks > 20 and bad == sorted([*want, ("c.csv", 1, "x is not a finite number")])
    assert good == 2 * sum(k % 37 > 4 for k in range(900)) + 1


def test_csv_of_nothing_but_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("X,Volume\n")
    assert [df.count() for df in readers.read_csv_strict(spark, str(tmp_path), {"x": "X"})] == [0, 0]
