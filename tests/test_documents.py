"""Text codec, migration, rules, pictures, readers and sinks."""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import expr
from tidemark.operators import ledger, migrate, rules, text
from tidemark.sources import images, readers, sinks

PLAIN = "\n".join([text.RULE, "SETUP", text.RULE, "Regions", "  Inlet: fixed", "    Probe 1", "  Value: 2.5", "    Probe 2", "  Value: 2.75", "    Probe 3", "  Value: 3.0", "Copies", "  A", "    Wall", "  Roughness: 0", "      Layer", "  B", "    Wall", "  Roughness: 0", "      Layer", ""])


def test_codec_round_trip_and_rules():
    c = text.encode(PLAIN)
    assert text.decode(c) == PLAIN and "== SETUP ==" in c and "@k=0..2" in c and " ^A" in c and len(c) - len(text.NOTATION) < len(PLAIN)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["Node", "Wall 1", "Wall 2", "Wall 3", "Key: 1", "x: {", "", "= ="])), max_size=25))
def test_codec_never_loses_anything(rows):
    plain = "\n".join("  " * d + n for d, n in rows)
    try:
        assert text.decode(text.encode(plain)) == plain
    except text.NotationError:
        pass  # refused, not wrong


def test_decoder_names_the_line():
    with pytest.raises(text.NotationError, match="line 2"):
        text.decode("A\nB ^Nowhere")


def test_redaction_and_trimming(spark):
    df = spark.createDataFrame([("user=ann file=/home/ann/x.txt C:\\tmp\\y.sim", "<p>a<script>x</script> <b>b</b></p>")], "line string, html string")
    r = df.select(text.redact(F.col("line"), ["user"]).alias("line"), text.strip_tags(F.col("html")).alias("html"), text.version_line(F.lit("a: 1 | b: two")).alias("v")).first()
    assert r["line"] == "user=(redacted) file=x.txt y.sim" and r["html"] == "a b" and r["v"] == {"a": "1", "b": "two"}


def test_migration_keeps_literals_and_order():
    doc = '{"b": 2.50, "a": [1, 2.0], "old": {"x_m": 1e3}}'
    edits = [("rename", "old", "reference"), ("resuffix", "reference", {"_m": "_metres"}), ("set", "version", 2), ("order", "", ["version"]), ("drop", "nothing")]
    new, report = migrate.migrate(doc, edits)
    assert not report.problems and '"b": 2.50' in new and "1e3" in new and list(json.loads(new)) == ["version", "b", "a", "reference"]
    again, second = migrate.migrate(new, [e for e in edits if e[0] != "rename"] + [("rename", "old", "reference")])
    assert again == new and not second.changed
    assert migrate.migrate("{", edits)[0] is None and migrate.migrate(doc, [("move", "zz", "old")])[0] is None


def test_insert_key_changes_nothing_else():
    assert migrate.insert_key('{\n  "a": 1.50\n}', "t", 3) == '{\n  "t": 3,\n  "a": 1.50\n}'


def test_json_leaves(spark):
    df = spark.createDataFrame([("d", '{"a": {"b": [1, {"c": true}]}, "e": null, "f": "x"}'), ("bad", "{,}")], "id string, t string")
    got = {(r["path"], r["value"]) for r in rules.json_leaves(df, ["id"], "t").collect()}
    assert got == {("a/b/0", "1"), ("a/b/1/c", "true"), ("e", None), ("f", "x")}


def artifacts(spark, files):
    return spark.createDataFrame([(c, p, bytearray(b), len(b)) for (c, p), b in files.items()], "capsule string, path string, content binary, length long")


PICTURE = images.encode_png(np.indices((8, 1024)).sum(axis=0)[..., None].repeat(3, axis=2) % 251)
BLANK = images.encode_png(np.zeros((8, 1024, 3)))


def good_tree(name="capsule_a", base="capsule_a"):
    """Files of a sound capsule, JSON still as objects."""
    quintet = {"cd": 1.0, "cd_sd": 0.1, "cd_window_iterations": 400, "cd_n_windows": 2, "cd_statistic": "iteration_mean"}
    summary = {
        "reference": {"length_m": 1.0, "velocity_m_per_s": 2.0}, "environment": {"solver": "s", "version": "1", "build": "b", "platform": "p", "precision": "double", "renders": {"precision": "mixed", "scope": ["views"]}},
        "convergence": {"status": "stationary", "uncertainty": {"cd_relative": 0.01, "basis": "two meshes", "source": "measured"}}, "forces": quintet, "balance": {"cd": 1.0, "cd_pressure": 0.7, "cd_friction": 0.3}, "extensions": ["diff"], "angle_deg": 45.0, "length_ratio_m": 2.0,
        "probes": {"axis": {"value": 1.0, "sd": 0.1, "window_iterations": 400, "n_windows": 2, "statistic": "iteration_mean"}}, "plane_extremes": {"statistic": "window_min_max", "window_iterations": 400, "n_windows": 2},
        "mesh": {"cells": 1000, "designed_for_Re_range": [100, 300], "wall": {"layers": 5, "layer_coverage": 0.9, "first_layer_D": 0.01}},
        "discretization": {"space": {"family": ["a", "b"], "iteration_error": [0.1, None], "order_band": [1, 3], "quantities": {"cd": {"behaviour": "monotone", "status": "converged"}}}},
    }
    manifest = {"views": [{"file": "views/v.png", "colorbar": {"levels": 256, "signed": True, "range": [-2.0, 2.0]}}]}
    digest = hashlib.sha256(PICTURE).hexdigest()
    pair = {"threshold_physical": 0.1, "threshold_comparison": ">=", "output": "diff/d.png", "base_view": "v.png", "variant_view": "v.png", "source_sha256": {"base_view": digest, "variant_view": digest}, "instrument_sha256": {"base_frame": digest, "variant_frame": digest}}
    diff = {
        "schema_version": "1", "base": {"alias": "a", "repo": "r", "commit": "0" * 40, "path": f"examples/{base}", "frozen_copy_path": "x"}, "variant": {}, "difference": {}, "view_contract": {"colorbar_levels": 256, "colormap_measured": "grayscale"},
        "pipeline": {"pixels_evaluated": 10}, "pairs": [pair], "scalar_deltas": {"cd": {"base": 1.0, "relative": 0.1}}, "known_differences": [],
    }
    signals = {"n_periods": 4, "window_tU_over_L": [10.0, 30.0], "period_tU_over_L": {"mean": 5.0, "sd": 0.1}}
    modes = {"n_periods": 4, "total_energy": 2.0, "modes": [{"energy_fraction": 0.7, "cumulative": 0.7}, {"energy_fraction": 0.2995, "cumulative": 0.9995}]}
    return {
        "setup.txt": b"Node\n", "summary.json": summary, "manifest.json": manifest, "diff.json": diff, "diff/d.png": PICTURE, "views/v.png": PICTURE, "planes/plane_x.png": PICTURE,
        "planes/plane_x.csv": b"# plane | grid 2 x 2 | spacing 0.1 | 4 of 4 nodes | fields %.3f | nondimensional\na,b\n", "signals/signals.json": signals, "modes/modes.json": modes,
    }


def put(path, value):
    """An edit: sets (or with ``...`` removes) what stands at a path, file first."""

    def edit(tree):
        file, *keys = path.split("#")
        if not keys:
            tree.update({file: value}) if value is not ... else tree.pop(file)
            return
        at, *rest = keys[0].split("/"), None
        node = tree[file]
        for k in at[:-1]:
            node = node[int(k) if isinstance(node, list) else k]
        last = int(at[-1]) if isinstance(node, list) else at[-1]
        if value is ...:
            del node[last]
        else:
            node[last] = value

    return edit


TEXT_CHUNK = PICTURE[:33] + b"\x00\x00\x00\x01tEXtx\x00\x00\x00\x00" + PICTURE[33:]
SMALL = images.encode_png(np.indices((8, 512)).sum(axis=0)[..., None].repeat(3, axis=2) % 251)
#: What is done to a sound capsule, and the findings that must follow (id, severity).
FAULTS = [
    (put("setup.txt", ...), "required_files E"), (put("summary.json", ...), "required_files E"), (put("notes.txt", b"x"), "declared_files E"), (put("views/a/b.png", PICTURE), "declared_files E"), (put("tools/x.png", PICTURE), "declared_files E"),
    (put("views/V 1.png", PICTURE), "declared_files E"), (put("setup.txt", b""), "not_empty E"), (put("disclosure.json", b""), "not_empty E"), (put("setup.txt", b"\xff\xfe"), "encoding E"), (put("setup.txt", b"Node\tKey: 1\n"), "setup_notation W"),
    (put("manifest.json", b"{,"), "json_parses E"), (put("manifest.json", b"\xef\xbb\xbf{}"), "json_parses W"), (put("summary.json#numerics", {}), "environment W"), (put("summary.json#environment", ...), "environment W"), (put("summary.json#environment/build", ...), "environment W"),
    (put("summary.json#environment/precision", "half"), "environment W"), (put("summary.json#environment/renders/scope", ["gone"]), "environment W"), (put("summary.json#environment/renders/scope", ["a/b"]), "environment W"), (put("summary.json#environment/renders/scope", ...), "environment W"),
    (put("summary.json#convergence/status", "diverged"), "summary_blocks W"), (put("summary.json#uncertainty", {}), "summary_blocks W"), (put("summary.json#forces/cd_sd", ...), "summary_blocks W"), (put("summary.json#forces/cd_n_windows", ...), "summary_blocks W"),
    (put("summary.json#forces/cd_statistic", "guess"), "summary_blocks W"), (put("summary.json#forces/cd_statistic", "window_min"), "summary_blocks W"), (put("summary.json#probes/axis/value", ...), "summary_blocks W"), (put("summary.json#plane_extremes/n_windows", ...), "summary_blocks W"),
    (put("summary.json#mass", {"mdot_in": 1.0}), "summary_blocks W"), (put("summary.json#mesh/cells", 10.5), "summary_blocks W"), (put("summary.json#mesh/designed_for_Re", 100), "summary_blocks W"), (put("summary.json#mesh/designed_for_Re_range", [300, 100]), "summary_blocks W"),
    (put("summary.json#mesh/wall/layers", ...), "summary_blocks W"), (put("summary.json#mesh/wall/layer_coverage", 1.5), "summary_blocks W"), (put("summary.json#mesh/wall/first_layer_D", 0), "summary_blocks W"), (put("summary.json#convergence/uncertainty/source", "felt"), "summary_blocks W"),
    (put("summary.json#convergence/uncertainty/basis", ...), "summary_blocks W"), (put("summary.json#balance/cd_friction", 0.5), "summary_blocks W"), (put("summary.json#discretization/space/quantities/cd/status", "fine"), "summary_blocks W"), (put("summary.json#discretization/space/order_band", ...), "summary_blocks W"),
    (put("summary.json#discretization/space/family", ["a"]), "summary_blocks W"), (put("summary.json#discretization/space/quantities/cd", {"behaviour": "oscillatory", "status": "reduced_order", "assumed": True}), "summary_blocks W"),
    (put("summary.json#discretization/space/quantities/cd", {"status": "above_order"}), "summary_blocks W"), (put("summary.json#discretization/space/quantities/cd", {"status": "not_asymptotic", "gci_fine": 1}), "summary_blocks W"),
    (put("planes/plane_x.png", ...), "plane_pairs E"), (put("planes/plane_x.csv", ...), "plane_pairs E"), (put("planes/note.txt", b"x"), "plane_pairs E"), (put("planes/plane_x.csv", b"a,b\n"), "csv_header E"), (put("planes/plane_x.csv", b"# grid 1 | spacing | 1 of 2 nodes | %.3f\n"), "csv_header E"),
    (put("planes/plane_x.csv", b"# nondimensional | grid 1 | spacing | %.3f\n"), "csv_header W"), (put("views/v.png", SMALL), "png_geometry E"), (put("views/w.png", b"no"), "png_geometry E"), (put("views/w.png", TEXT_CHUNK), "png_metadata E"), (put("views/w.png", BLANK), "view_field W"),
    (put("manifest.json#views/0/colorbar/signed", 1), "signed_range W"), (put("manifest.json#views/0/colorbar/range", [-1, 2]), "signed_range W"), (put("manifest.json#views/0/colorbar/range", ...), "signed_range W"), (put("signals/signals.json#period_tU_over_L/mean", 6.0), "transient_layers W"),
    (put("signals/signals.json#period_tU_over_L/sd", -1), "transient_layers W"), (put("modes/modes.json#modes/1/cumulative", 0.9), "transient_layers W"), (put("modes/modes.json#modes/1", {"energy_fraction": 0.1, "cumulative": 0.8}), "transient_layers W"), (put("modes/modes.json#n_periods", 5), "transient_layers W"),
    (put("modes/modes.json#total_energy", 0), "transient_layers W"), (put("summary.json#reference", ...), "reference_block E"), (put("summary.json#forces/lift_n", 1.0), "dimensional_flags W"), (put("summary.json#reference/velocity", 1.0), "dimensional_flags W"),
    (put("summary.json#reference/pressure_Pa", 1.0), "dimensional_flags W"), (put("summary.json#reference/rho", {"value": 1, "unit": "kg"}), "dimensional_flags W"), (put("summary.json#extensions", ...), "extensions E"), (put("summary.json#extensions", ["diff", "diff"]), "extensions E"),
    (put("summary.json#extensions", ["diff", "audio"]), "extensions E"), (put("diff.json", ...), "extensions E"), (put("diff/d.png", ...), "extensions E"), (put("diffsrc/a.png", PICTURE), "no_instrument_dir E"), (put("diff.json#pipeline", ...), "diff_manifest E"),
    (put("diff.json#base/alias", ...), "diff_manifest E"), (put("diff.json#base/repo", ...), "diff_manifest E"), (put("diff.json#base/commit", "main"), "diff_manifest E"), (put("diff.json#base/commit", "0" * 7), "diff_manifest W"), (put("diff.json#view_contract/colorbar_levels", 64), "diff_manifest E"),
    (put("diff.json#view_contract/colormap_measured", "jet"), "diff_manifest W"), (put("diff.json#pipeline/pixels_evaluated", "many"), "diff_manifest E"), (put("diff.json#pairs/0/threshold_physical", "x"), "diff_manifest E"), (put("diff.json#pairs/0/threshold_comparison", "<"), "diff_manifest E"),
    (put("diff.json#pairs/0/output", "views/d.png"), "diff_manifest E"), (put("diff.json#pairs/0/output", "e.png"), "diff_manifest E"), (put("diff.json#pairs/0/base_view", "views/v.png"), "diff_manifest E"), (put("diff.json#scalar_deltas/cd/base", 0.0), "diff_manifest W"),
    (put("diff.json#pairs/0/instrument_sha256", ...), "diff_view_hashes W"), (put("diff.json#pairs/0/source_sha256/base_view", "00"), "diff_view_hashes W"), (put("diff.json#pairs/0/source_sha256/variant_view", "0" * 64), "diff_view_hashes E"), (put("diff.json#base/path", "examples/capsule_gone"), "diff_view_hashes W"),
    (put("diff.json#pairs/0/variant_view", "gone.png"), "diff_view_hashes E"), (put("summary.json#status", "draft"), "publication_residue W"), (put("manifest.json#views/0/_todo", 1), "publication_residue W"), (put("setup.txt", "a \u2014 b\n".encode()), "punctuation W"), (put("manifest.json#note", "a \u2212 b"), "punctuation E"),
]


@pytest.fixture(scope="module")
def judged(spark):
    """Findings of the sound capsule and of every faulty one, and their roll-up."""
    trees = {"capsule_a": good_tree(), "Case": good_tree()}
    for i, (edit, _) in enumerate(FAULTS):
        trees[f"capsule_f{i}"] = good_tree()
        edit(trees[f"capsule_f{i}"])
    as_bytes = lambda v: v if isinstance(v, bytes) else json.dumps(v, ensure_ascii=False).encode()
    a = artifacts(spark, {(c, p): as_bytes(v) for c, t in trees.items() for p, v in t.items()})
    found = rules.validate(a).collect()
    frame = spark.createDataFrame(found, "capsule string, check_id string, severity string, message string, path string")
    return found, {strict: {r["capsule"]: r["status"] for r in rules.rollup(frame, a, strict).collect()} for strict in (False, True)}


def test_sound_capsule_has_no_finding(judged):
    found, status = judged
    assert [r for r in found if r["capsule"] == "capsule_a"] == [] and status[True]["capsule_a"] == "PASS"
    assert {(r["check_id"], r["severity"]) for r in found if r["capsule"] == "Case"} == {("root", "E")} and status[False]["Case"] == "FAIL"


@pytest.mark.parametrize("i", range(len(FAULTS)))
def test_each_fault_is_found(judged, i):
    found, status = judged
    mine = {f"{r['check_id']} {r['severity']}" for r in found if r["capsule"] == f"capsule_f{i}"}
    assert FAULTS[i][1] in mine, mine
    worst = "FAIL" if any(m.endswith("E") for m in mine) else "WARN"
    assert status[False][f"capsule_f{i}"] == worst and status[True][f"capsule_f{i}"] == "FAIL"


def test_every_rule_has_a_fault():
    assert {f.split()[0] for _, f in FAULTS} | {"root"} == {c.__name__ if c.__name__ != "root_name" else "root" for c in rules.CHECKS}


def test_deep_keys_are_seen_and_errors_have_a_place(spark):
    deep = {"_x": 1}
    for _ in range(200):
        deep = {"a": deep}
    docs = spark.createDataFrame([("c", "f", json.dumps(deep)), ("c", "g", '{"a": 1,\n "b" 2}')], "capsule string, file string, text string")
    got = rules.json_nodes(docs).collect()
    assert max(r["depth"] for r in got) == 201 and [r["value"] for r in got if r["kind"] == "error"] == ["line 2 column 6: Expecting ':' delimiter"]
    assert {r["name"] for r in rules.json_leaves(docs.limit(1).withColumn("text", F.lit(json.dumps({"a": {"b": {"c": [{"d": {"e": {"f": {"g": {"h": {"i": {"j": 1}}}}}}}]}}}))), ["file"], "text").collect()} == {"j"}


def test_png_filters_round_trip():
    import struct
    import zlib

    rng = np.random.default_rng(2)
    want = rng.integers(0, 256, (6, 5, 3)).astype(np.uint8)
    raw, before = b"", np.zeros(15, np.int64)
    for y, row in enumerate(want.reshape(6, -1).astype(np.int64)):
        kind = y % 5
        left, corner = np.concatenate([[0] * 3, row[:-3]]), np.concatenate([[0] * 3, before[:-3]])
        p = left + before - corner
        paeth = np.where((abs(p - left) <= abs(p - before)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - before) <= abs(p - corner), before, corner))
        guess = (0, left, before, (left + before) // 2, paeth)[kind]
        raw += bytes([kind]) + ((row - guess) % 256).astype(np.uint8).tobytes()
        before = row
    part = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    png = images.SIGNATURE + part(b"IHDR", struct.pack(">IIBBBBB", 5, 6, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")
    assert (images.decode_png(png) == want).all() and (images.decode_png(images.encode_png(want)) == want).all()


def test_frames(spark):
    png = images.encode_png(np.full((3, 2, 3), 7))
    rows = images.frames(spark.createDataFrame([("a", bytearray(png)), ("b", bytearray(b"no"))], "id string, content binary"), crop_rows=1).collect()
    assert {r["id"]: r["height"] for r in rows} == {"a": 2, "b": None} and rows[0]["pixels"] == [7] * 12


def test_readers(spark, tmp_path):
    (tmp_path / "c.csv").write_text('"X (m)",Volume (m^3),note\n1.0,2.0,a\n\n3.0,bad,b\n4.0,-1,c\n')
    good, bad = readers.read_csv_strict(spark, str(tmp_path / "c.csv"), {"x": "X", "volume": "Volume"}, positive=("volume",))
    assert [tuple(r) for r in good.collect()] == [(1.0, 2.0)] and {r["reason"] for r in bad.collect()} == {"volume is not a finite number", "volume is not positive"}
    with pytest.raises(readers.ColumnError):
        readers.resolve_columns(["u_x", "v_x"], {"x": "x"}, "contains")
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "cd.csv").write_text("tU_D,cd\n0,1.5\n1,2.5\n")
    assert sorted(tuple(r) for r in readers.read_signals(spark, str(tmp_path / "s")).select("signal", "t", "y").collect()) == [("cd", 0.0, 1.5), ("cd", 1.0, 2.5)]
    digest = hashlib.sha256(b"x").hexdigest()
    (tmp_path / "list").write_text(f"# note\n{digest}  a/b.txt\n")
    assert tuple(readers.read_hash_list(spark, str(tmp_path / "list")).first()) == (digest, "a/b.txt")
    (tmp_path / "root" / "capsule_x" / "planes").mkdir(parents=True)
    (tmp_path / "root" / "capsule_x" / "planes" / "p.csv").write_text("# a\n")
    (tmp_path / "root" / "capsule_x.md").write_text("beside the folder")
    assert [(r["capsule"], r["path"]) for r in readers.scan_artifacts(spark, str(tmp_path / "root")).collect()] == [("capsule_x", "planes/p.csv")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 0.0, -0.0001), (0.0, 1.0, 1.0005)], "a double, b double, f double")
    sinks.write_plane(df, str(tmp_path / "p.csv"), "a", "b", ["f"], "plane")
    assert (tmp_path / "p.csv").read_text() == "# plane\na,b,f\n1.000,0.000,0.000\n0.000,1.000,1.000\n"
    sinks.write_zip(str(tmp_path), str(tmp_path.parent / "z1.zip"))
    sinks.write_zip(str(tmp_path), str(tmp_path.parent / "z2.zip"))
    assert (tmp_path.parent / "z1.zip").read_bytes() == (tmp_path.parent / "z2.zip").read_bytes()
    state = {"n": 0}
    assert sinks.settle(lambda: min(3, state["n"] + 1), lambda v: state.update(n=v)) == 3


def test_expressions(spark):
    df = spark.createDataFrame([(1234, 0.5, 91.0, float("nan"))], "n long, half double, angle double, odd double")
    r = df.select(expr.two_significant("n").alias("two"), expr.tokens_of(F.lit(1.25)).alias("even"), expr.reduce90("angle").alias("angle"), expr.close("odd", F.lit(None).cast("double")).alias("odd"), expr.strouhal_correlation(F.lit(100.0)).alias("st")).first()
    assert (r["two"], r["even"], r["angle"], r["odd"]) == (1200, 0, -89.0, True) and r["st"] == pytest.approx(0.1643, abs=1e-4)


def test_ledger_totals_add_up(spark):
    df = spark.createDataFrame([("a", "x/1.csv", 10), ("a", "x/2.csv", 15), ("a", "s.json", 7)], "c string, path string, n long")
    rows = ledger.measured(df, ledger.layer_of(F.col("path")), F.col("n"), F.lit(2.5))
    got = {r["layer"]: r["tokens"] for r in ledger.ledger(rows, ["c"], 100).collect()}
    assert got == {"x": 10, "s.json": 3, None: 13}
