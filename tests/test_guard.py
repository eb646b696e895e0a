"""The guard over histories: a run that keeps the contract, and one broken rule at a time."""

from __future__ import annotations

import copy
import json
import math
import random
import statistics

import pytest

from tidemark.operators import guard as g
from tidemark.streaming import gate

RE = 300


def history(seed=1, windows=2):
    """Rows on the sampling grid: steady oscillations behind the transient."""
    rng = random.Random(seed)
    rows = []
    for k in range(1, 100 + 200 * windows + 1):
        row = {"iteration": 10 * k}
        for j, c in enumerate(g.HEADER[1:]):
            row[c] = (0.5 + 0.1 * j) + 0.05 * math.sin(0.9 * k + j) + rng.gauss(0, 0.005)
        row["mass_imbalance"] = 1e-5 * math.sin(k)
        rows.append(row)
    return rows


def csv(rows):
    return "\n".join([",".join(g.HEADER), *[",".join([str(r["iteration"]), *[repr(r[c]) for c in g.HEADER[1:]]]) for r in rows], ""]).encode()


def summary(rows):
    """What the contract wants published of a run that becomes stationary with its last window; plain Python."""
    own = rows[100:]
    k = len(own) // g.SIZE
    wi, pool = 2000 * k, {c: [r[c] for r in own] for c in g.HEADER[1:]}
    quantities = {}
    for c in g.GATED:
        w = [gate.window_of(pool[c][g.SIZE * i : g.SIZE * (i + 1)]) for i in range(k)]
        (ma, sa, ca), (mb, sb, cb) = w[-2:]
        n = min(ca, cb)
        quantities[c] = {"window_means": [x[0] for x in w], "window_sds": [x[1] for x in w], "n_cycles_last": cb, "drift_last": mb - ma, "drift_over_se": abs(mb - ma) / math.sqrt((sa**2 + sb**2) / n), "sd_log_ratio_over_tol": abs(math.log(sb / sa)) / (3 / math.sqrt(n)), "pass": True}

    def told(c, name=None, kind="mean", sd=True, by=1.0):
        name = name or c
        v = {"mean": statistics.fmean, "min": min, "max": max}[kind](pool[c]) / by
        stat = "iteration_mean" if kind == "mean" else f"window_{kind}"
        return {name: v, f"{name}_window_iterations": wi, f"{name}_n_windows": k, f"{name}_statistic": stat} | ({f"{name}_sd": statistics.stdev(pool[c]) / by} if sd else {})

    scale = 1.2 * 3.0 * 0.5 * 0.5
    return {
        "sweep": {"value": RE}, "reference": {"density_kg_per_m3": 1.2, "velocity_m_per_s": 3.0, "side_m": 0.5},
        "convergence": dict(g.CONSTANTS) | {
            "status": "stationary", "iterations": rows[-1]["iteration"], "windows_closed": k, "quantities": quantities, "time_basis": "iterations", "regime_expected": {"value": "unsteady", "source": "declared", "ref": "book"}, "solver_regime_mismatch": False,
            "stop_reason": "Window statistics of cd, cl, cy, cp_base stationary between iterations 1-2 and 3-4 (max drift/SE = 0.5).", "uncertainty": {"cd_relative": 0.01, "source": "declared"},
        },
        "forces": told("cd") | told("cl") | told("cy") | told("cd_pressure") | told("cd_friction"), "pressure": told("cp_base") | told("cp_min", kind="min", sd=False) | told("cp_stagnation", kind="max", sd=False),
        "wake": told("x_reattach", "x_reattach_D") | told("recirculation_length_D") | {"note": g.WAKE_NOTE}, "mass": told("mdot_in", "mdot_in_over_rhoUD2", by=scale) | told("mdot_out", "mdot_out_over_rhoUD2", by=scale) | told("mass_imbalance"),
        "probes": {g.PROBE: {"value": statistics.fmean(pool[g.PROBE]), "sd": statistics.stdev(pool[g.PROBE]), "window_iterations": wi, "n_windows": k, "statistic": "iteration_mean", "position_D": [2.0, 0.0, 0.0]}},
        "plane_extremes": {p: {f: [min(pool[f"LLM_{f}_min_{p}"]), max(pool[f"LLM_{f}_max_{p}"])] for f in g.FIELDS} for p in g.PLANES} | {"statistic": "window_min_max", "window_iterations": wi, "n_windows": k},
    }


def put(path, value):
    def edit(s, rows):
        *where, last = path.split("/")
        for k in where:
            s = s[int(k) if isinstance(s, list) else k]
        last = int(last) if isinstance(s, list) else last
        if value is ...:
            del s[last]
        else:
            s[last] = value

    return edit


def in_row(k, c, value):
    return lambda s, rows: rows[k].update({c: value})


#: A change to a sound run, and the rules that must then fail.
FAULTS = {
    "value": (put("sweep/value", 301), {"G01"}), "off grid": (in_row(3, "iteration", 41), {"G03"}), "iterations": (put("convergence/iterations", 10), {"G03", "G08"}), "constant": (put("convergence/k_sd", 2.0), {"G04"}),
    "regime": (put("convergence/regime_expected/value", "steady"), {"G04"}), "mismatch": (put("convergence/solver_regime_mismatch", True), {"G04"}), "basis": (put("convergence/time_basis", ...), {"G04"}), "status": (put("convergence/status", "finished"), {"G05", "G08", "G10", "G11", "G12"}),
    "retired": (put("convergence/band_low", 1), {"G05"}), "retired value": (put("convergence/mode", "limit_cycle"), {"G05"}), "closed": (put("convergence/windows_closed", 3), {"G06"}), "mean": (put("convergence/quantities/cl/window_means/0", 9.0), {"G06"}),
    "one mean more": (lambda s, rows: s["convergence"]["quantities"]["cl"]["window_means"].append(1.0), {"G06"}), "cycles": (put("convergence/quantities/cd/n_cycles_last", 1), {"G07"}), "drift": (put("convergence/quantities/cy/drift_last", 1.0), {"G07"}),
    "pass": (put("convergence/quantities/cy/pass", False), {"G07"}), "reason": (put("convergence/stop_reason", "it stopped"), {"G08"}), "uncertainty": (put("convergence/uncertainty/cd_relative", 0.5), {"G09"}), "no uncertainty": (put("convergence/uncertainty", ...), {"G09"}),
    "cd": (put("forces/cd", 9.0), {"G10"}), "sd": (put("forces/cl_sd", 9.0), {"G10"}), "companion": (put("mass/mass_imbalance_n_windows", 9), {"G10"}), "reference": (put("reference/side_m", ...), {"G10"}), "wake": (put("wake/x_reattach_D", 9.0), {"G11"}),
    "note": (put("wake/note", "x"), {"G11"}), "probe": (put(f"probes/{g.PROBE}/position_D/0", 1.0), {"G11"}), "minimum": (put("pressure/cp_min", 0.0), {"G12"}), "plane": (put("plane_extremes/x1/cp/1", 0.0), {"G12"}), "plane key": (put("plane_extremes/x1/more", [0, 0]), {"G12"}),
    "single": (put("forces/extra", 1.0), {"G13"}), "unit": (put("forces/force_kg_per_m3", 1.0), {"G13", "G14"}), "flow": (put("mass/mdot_in", 1.0), {"G13", "G14"}), "not a number": (in_row(7, "cd", "x"), {"G03"}),
}


@pytest.fixture(scope="module")
def judged(spark):
    files = []
    for name, (edit, _) in ({"sound": (lambda s, rows: None, set())} | FAULTS).items():
        rows = history()
        s = copy.deepcopy(summary(rows))
        edit(s, rows)
        files += [(name, "summary.json", json.dumps(s).encode()), (name, f"monitor_history_re{RE:04d}.csv", csv(rows).replace(b"'x'", b"x"))]
    files += [("bare", "summary.json", b"{}"), ("header", "summary.json", json.dumps(summary(history())).encode()), ("header", "monitor_history_re0300.csv", csv(history()).replace(b"iteration,cd", b"iteration,drag"))]
    rows = history()
    rows[250]["cd"] = float("nan")
    files += [("nan", "summary.json", json.dumps(summary(history())).encode()), ("nan", "monitor_history_re0300.csv", csv(rows))]
    a = spark.createDataFrame([(c, p, bytearray(b), len(b)) for c, p, b in files], "capsule string, path string, content binary, length long")
    declared = spark.createDataFrame([(RE, "unsteady", json.dumps({"source": "declared", "cd_relative": 0.01})), (301, "unsteady", json.dumps({"source": "declared", "cd_relative": 0.01}))], "re long, regime_expected string, uncertainty string")
    out = {}
    for r in g.guard(a, declared, "book").collect():
        out.setdefault(r["capsule"], {})[r["rule"]] = r["detail"]
    return out


def test_sound_run_keeps_all_rules(judged):
    assert judged["sound"] == {f"G{k:02d}": "" for k in range(1, 15)}


@pytest.mark.parametrize("name", sorted(FAULTS))
def test_each_fault_breaks_its_rule(judged, name):
    broken = {r for r, d in judged[name].items() if d}
    assert broken == FAULTS[name][1], judged[name]


def test_what_can_not_be_replayed(judged):
    assert set(judged["bare"]) == {"G01"} and judged["bare"]["G01"]
    assert judged["header"]["G02"] and set(judged["header"]) == {"G01", "G02", "G03"}
    assert "status" in judged["nan"]["G08"] and "iterations" in judged["nan"]["G08"]


def test_a_history_is_split_once(spark):
    """Neither heads nor rows split the file again for each of its lines: both read the rows that were parsed once."""
    lines = [",".join(g.HEADER), *[",".join(str(10 * k) for _ in g.HEADER) for k in range(1, 2001)]]
    files = [("long", "monitor_history_re0300.csv", "\r\n".join(lines)), ("empty", "monitor_history_re0300.csv", ""), ("odd", "monitor_history_re0300.csv", f"{lines[0]}\nx,1"), ("bare", "monitor_history_re0300.csv", lines[0])]
    heads, rows = g.histories(spark.createDataFrame(files, "capsule string, path string, text string"))
    for df in (heads, rows):
        assert "Generate" not in df._jdf.queryExecution().optimizedPlan().toString()
    found = {r["capsule"]: (r["header"], r["numeric"], r["rows"]) for r in heads.collect()}
    assert found == {"long": (list(g.HEADER), True, 2000), "empty": ([""], False, 0), "odd": (list(g.HEADER), False, 1), "bare": (list(g.HEADER), False, 0)}
    assert sorted((r["capsule"], r["line"], r["cd"]) for r in rows.collect()) == [("long", k, 10.0 * (k + 1)) for k in range(2000)]
