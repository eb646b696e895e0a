"""The guard over histories: what a summary publishes, recomputed from the run's own history, as 14 rules.

All runs go through one plan: the histories are exploded into rows, windows, gate and decision come from
:mod:`tidemark.operators.windows`, pooled statistics from one aggregation, and each rule is a column over one row per run.

Cases: a run without summary or with no or several histories only fails G01; one whose header or rows are not as they
must be fails G02 or G03 and is not replayed; a short window fails G06; nulls and NaN equal each other; other files and
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import reason_fits
from tidemark.operators import windows
from tidemark.operators.rules import json_nodes, texts
from tidemark.session import stored

# --- fixed values of the contract ------------------------------------------------------------------------------------

CONSTANTS = {
    "criterion": "window_stationarity", "criterion_version": 2, "discard_iterations": 1000, "window_iterations": 2000, "sampling_interval": 10,
    "max_iterations": 15000, "k_gate": 2.0, "k_sd": 3.0, "min_cycles": 10,
}
MASS_LIMIT, MASS_GRACE, TOLERANCE = 1e-3, 100, 1e-9
GATED = ("cd", "cl", "cy", "cp_base")
PLANES, FIELDS = ("y0", "x1", "x2", "x4"), ("cp", "u_over_U")
COMPONENTS = ("cd_pressure", "cd_friction", "mdot_in", "mdot_out")
PROBE = "LLM_u_over_U_axis_x2D"
LOWS = tuple(f"LLM_{f}_min_{p}" for p in PLANES for f in FIELDS)
HIGHS = tuple(f"LLM_{f}_max_{p}" for p in PLANES for f in FIELDS)
HEADER = ("iteration", *GATED, "mass_imbalance", *COMPONENTS, "x_reattach", "recirculation_length_D", PROBE, "cp_min", "cp_stagnation", *LOWS, *HIGHS)
STATUSES = ("converged", "stationary", "no_steady_state", "diverged")
RETIRED = ("limit_cycle", "cd_band_last_500", "band_tolerance", "period_iterations_last")
SAMPLED_BLOCKS = ("forces", "pressure", "wake", "probes", "plane_extremes", "mass")
WAKE_NOTE = "mean of instantaneous lengths; not the recirculation length of the time-averaged field, which is out of scope for this part"
UNIT_SUFFIX = r"_(m|s|kg|pa|m_s|kg_m3|pa_s|(?:m|s|kg|pa)[23]?(?:_per_(?:m|s|kg|pa)[23]?)+)$"

SIZE = CONSTANTS["window_iterations"] // CONSTANTS["sampling_interval"]
_REFERENCE = ("density_kg_per_m3", "velocity_m_per_s", "side_m")


def close(a: Column, b: Column) -> Column:
    """Equal up to the tolerance; values that are missing or not finite equal each other."""
    none = lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True))
    near = F.abs(a - b) <= TOLERANCE * F.greatest(F.lit(1.0), F.abs(a), F.abs(b))
    return F.when(none(a) | none(b), none(a) & none(b)).otherwise(near)


def histories(artifacts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per history file capsule, name, header and whether all rows are numeric; and its rows: capsule, line, one column per name of HEADER. Rows are parsed and written once."""
    files = artifacts.filter(F.col("path").rlike(r"^monitor_history_re.*\.csv$") & F.col("text").isNotNull())
    lines = F.filter(F.split("text", r"\r\n|\r|\n"), lambda x: x != "")
    # A file is split once, below the explode: above it, its header would be looked up again for each of its rows.
    files = files.select("capsule", "path", lines.alias("lines"))
    files = files.select("capsule", "path", F.split(F.coalesce(F.try_element_at("lines", F.lit(1)), F.lit("")), ",").alias("header"), F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0))).alias("body"))
    split = files.select("capsule", "path", "header", F.posexplode_outer("body").alias("line", "row"))
    cells = split.withColumn("v", F.transform(F.split("row", ","), lambda x: F.trim(x).try_cast("double")))
    whole = F.coalesce((F.size("v") == len(HEADER)) & ~F.exists("v", lambda x: x.isNull()), F.lit(False))
    head = F.when(F.coalesce("line", F.lit(0)) == 0, F.col("header"))
    cells = cells.select("capsule", "path", head.alias("header"), "line", F.col("row").isNotNull().alias("there"), whole.alias("whole"), "v")
    cells = stored(cells.select("capsule", "path", "header", "line", "there", "whole", *[F.when(F.col("whole"), F.col("v")[k]).alias(c) for k, c in enumerate(HEADER)]), "histories")
    heads = cells.groupBy("capsule", "path").agg(F.first("header", ignorenulls=True).alias("header"), F.bool_and("whole").alias("numeric"), F.count_if("there").alias("rows"))
    return heads, cells.filter("whole").select("capsule", "line", *HEADER)


def replayed(rows: DataFrame) -> DataFrame:
    """One row per run: status, stop (iteration), closed (windows), q (per gated quantity its windows and last gate), pooled statistics, last row."""
    step, first = CONSTANTS["sampling_interval"], CONSTANTS["discard_iterations"]
    rows = rows.withColumn("i", ((F.col("iteration") - first) / step - 1).cast("bigint"))
    odd = F.lit(False)
    for c in (*GATED, "mass_imbalance"):
        odd = odd | F.isnan(c) | (F.abs(c) == float("inf"))
    bad = odd | (F.col("iteration") >= MASS_GRACE) & (F.abs("mass_imbalance") > MASS_LIMIT)
    off = windows.first_offender(rows, ["capsule"], bad)
    long = rows.filter("i >= 0").select("capsule", "i", F.explode(F.create_map(*[x for c in GATED for x in (F.lit(c), F.col(c))])).alias("signal", "value"))
    key = ["capsule", "signal"]
    stats = windows.schmitt_cycles(long, windows.window_stats(long, SIZE, key), SIZE, key).checkpoint()
    gate = windows.stationarity_gate(stats, key, CONSTANTS["min_cycles"], CONSTANTS["k_gate"], CONSTANTS["k_sd"])
    every = rows.select("capsule").distinct()
    decided = windows.stop_decision(stats, gate, ["capsule"], ["signal"], SIZE, off)
    early = off.join(decided.select("capsule"), "capsule", "left_anti").select("capsule", F.lit("diverged").alias("status"), F.lit(None).cast("bigint").alias("window"), F.col("diverged_at").alias("stopped_at"))
    decision = every.join(decided.unionByName(early), "capsule", "left")
    decision = decision.withColumn("closed", F.when(F.col("status") == "diverged", F.greatest(F.floor(F.col("stopped_at") / SIZE), F.lit(0))).otherwise(F.coalesce(F.col("window") + 1, F.lit(0))).cast("bigint"))
    decision = decision.withColumn("stop", (F.col("stopped_at") + 1) * step + first)
    kept = stats.join(decision.select("capsule", "closed"), "capsule").filter("window < closed")
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("window", c))), lambda s: s[c])
    per = kept.groupBy("capsule", "signal").agg(ordered("mean").alias("means"), ordered("sd").alias("sds"), F.max_by("cycles", "window").alias("cycles"))
    final = gate.join(decision.select("capsule", "closed"), "capsule").filter("window = closed - 1").select("capsule", "signal", F.struct("drift", "drift_over_se", "sd_ratio_over_tol", "passed").alias("gate"))
    q = per.join(final, key, "left").groupBy("capsule").agg(F.map_from_entries(F.collect_list(F.struct("signal", F.struct("means", "sds", "cycles", "gate").alias("v")))).alias("q"))
    inside = rows.join(decision.select("capsule", "closed"), "capsule").filter((F.col("i") >= 0) & (F.col("i") < F.col("closed") * SIZE))
    pool = inside.groupBy("capsule").agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("sd"), F.min(c).alias("min"), F.max(c).alias("max")).alias(f"p_{c}") for c in HEADER[1:]])
    short = inside.groupBy("capsule").agg((F.count(F.lit(1)) != F.first("closed") * SIZE).alias("short"))
    last = rows.groupBy("capsule").agg(*[F.max_by(c, "line").alias(f"l_{c}") for c in HEADER])
    out = decision
    for part in (q, pool, short, last):
        out = out.join(part, "capsule", "left")
    return out


def guard(artifacts: DataFrame, declared: DataFrame, regime_ref: str | None = None) -> DataFrame:
    """capsule, rule, ok, detail for G01 to G14 of every run.

    ``artifacts``: capsule, path, content, length. ``declared``: re (the swept value), regime_expected, uncertainty (JSON text
    or null): one row per point.
    """
    a = texts(artifacts)
    summary = a.filter(F.col("path") == "summary.json").select("capsule", F.col("path").alias("file"), "text")
    nodes = json_nodes(summary).filter(F.col("kind") != "error")
    entry = F.struct("path", F.struct("kind", "value", "number").alias("v"))
    s = nodes.groupBy("capsule").agg(
        F.map_from_entries(F.collect_list(entry)).alias("s"),
        F.collect_set(F.when(F.col("name").isin(*RETIRED) | F.col("name").startswith("band_") | F.col("value").isin("limit_cycle", "max_steps"), F.col("path"))).alias("retired"),
        F.collect_set(F.when((F.col("depth") > 0) & ~F.col("path").rlike("^reference(/|$)") & F.col("name").rlike(UNIT_SUFFIX), F.col("path"))).alias("units"),
        F.collect_set(F.when(F.col("parent") == "mass", F.col("name"))).alias("mass_keys"),
        F.collect_list(F.when(F.col("parent").isin(*SAMPLED_BLOCKS), F.struct("parent", "name", "kind"))).alias("blocks"),
    )
    uncertainty = F.try_variant_get(F.try_parse_json("text"), "$.convergence.uncertainty", "variant").cast("string")
    s = s.join(summary.select("capsule", uncertainty.alias("uncertainty")), "capsule")
    heads, rows = histories(a)
    files = heads.groupBy("capsule").agg(F.count(F.lit(1)).alias("files"), F.first("path").alias("history"), F.first("header").alias("header"), F.bool_and("numeric").alias("numeric"))
    grid = windows.on_grid(rows, ["capsule"], CONSTANTS["sampling_interval"], "iteration").withColumnRenamed("last", "grid_last")
    d = declared.select(F.col("re").cast("double").alias("re"), F.col("regime_expected").alias("regime"), F.try_parse_json("uncertainty").cast("string").alias("declared_uncertainty"))
    base = a.select("capsule").distinct().join(s, "capsule", "left").join(files, "capsule", "left").join(grid, "capsule", "left")
    base = base.withColumn("re", F.try_element_at("s", F.lit("sweep/value"))["number"]).join(F.broadcast(d), "re", "left")
    base = base.join(replayed(rows), "capsule", "left")

    at = lambda path: F.try_element_at("s", F.lit(path) if isinstance(path, str) else path)
    number = lambda path: at(path)["number"]
    value = lambda path: at(path)["value"]
    has = lambda path: at(path).isNotNull()
    true = lambda c: F.coalesce(c, F.lit(False))
    conv = lambda k: f"convergence/{k}"
    listed = lambda *tests: F.array_join(F.filter(F.array(*[F.when(~true(ok), F.lit(label)) for label, ok in tests]), lambda x: x.isNotNull()), ", ")

    both = has("") & true(F.col("files") == 1)
    header = true(F.col("header") == F.array(*map(F.lit, HEADER)))
    readable = both & header & true(F.col("numeric")) & true(F.col("rows") > 0)
    status = value(conv("status"))
    pooled = status.isin("stationary", "no_steady_state") & (F.col("closed") > 0)
    kind_mean = F.when(pooled, "iteration_mean").otherwise("instantaneous")
    wi = F.when(pooled, F.col("closed") * CONSTANTS["window_iterations"]).otherwise(1)
    nw = F.when(pooled, F.col("closed")).when(status == "converged", 1).otherwise(0)

    def published(block: str, key: str, series: str, kind: str = "mean", sd: bool = True, scale: Column | None = None) -> list[tuple[str, Column]]:
        """What must hold for one published magnitude: value, sd and the three companions."""
        by = F.lit(1.0) if scale is None else scale
        path = f"{block}/{key}"
        want = F.when(pooled, F.col(f"p_{series}.{kind}")).otherwise(F.col(f"l_{series}")) / by
        spread = F.when(pooled, F.col(f"p_{series}.sd")).otherwise(0.0) / by
        told = kind_mean if kind == "mean" else F.when(pooled, f"window_{kind}").otherwise("instantaneous")
        tests = [(path, close(want, number(path))), (f"{path} companions", (number(f"{path}_window_iterations") == wi) & (number(f"{path}_n_windows") == nw) & (value(f"{path}_statistic") == told))]
        return tests + ([(f"{path}_sd", close(spread, number(f"{path}_sd")))] if sd else [])

    scale = number(f"reference/{_REFERENCE[0]}") * number(f"reference/{_REFERENCE[1]}") * number(f"reference/{_REFERENCE[2]}") * number(f"reference/{_REFERENCE[2]}")
    scale = F.when(scale != 0, scale)
    item = lambda prefix: lambda k: F.try_element_at("s", F.concat(F.lit(prefix), k.cast("string")))["number"]
    below = lambda path: lambda x: x.rlike(f"^{path}/[^/]+$")
    windows_equal = []
    gates_equal = []
    for c in GATED:
        q = F.try_element_at("q", F.lit(c))
        for mine, theirs in (("means", "window_means"), ("sds", "window_sds")):
            own = F.coalesce(q[mine], F.array().cast("array<double>"))
            told = F.transform(F.sequence(F.lit(0), F.greatest(F.size(own) - 1, F.lit(0))), item(f"convergence/quantities/{c}/{theirs}/"))
            more = has(F.concat(F.lit(f"convergence/quantities/{c}/{theirs}/"), F.size(own).cast("string")))
            same = F.when(F.size(own) == 0, F.lit(True)).otherwise(F.forall(F.arrays_zip(own.alias("a"), told.alias("b")), lambda z: close(z["a"], z["b"])))
            windows_equal.append((f"{c}.{theirs}", same & ~more))
        e = f"convergence/quantities/{c}"
        gates_equal.append((f"{c}.cycles", (F.col("closed") == 0) | (number(f"{e}/n_cycles_last") == q["cycles"])))
        g = q["gate"]
        gates_equal.append((f"{c}.gate", g.isNull() | close(g["drift"], number(f"{e}/drift_last")) & close(g["drift_over_se"], number(f"{e}/drift_over_se")) & close(g["sd_ratio_over_tol"], number(f"{e}/sd_log_ratio_over_tol")) & (value(f"{e}/pass") == g["passed"].cast("string"))))

    constants = [(k, (value(conv(k)) == v) if isinstance(v, str) else (number(conv(k)) == v)) for k, v in CONSTANTS.items()]
    expected = conv("regime_expected")
    mismatch = (status == "converged") & (F.col("regime") != "steady")
    regime = [
        ("regime_expected", F.when(F.col("regime").isNull(), (at(f"{expected}/value")["kind"] == "null") & (value(f"{expected}/source") == "not declared")).otherwise((value(f"{expected}/value") == F.col("regime")) & (value(f"{expected}/source") == "declared") & F.coalesce(value(f"{expected}/ref"), F.lit("")).eqNullSafe(F.lit(regime_ref or "")))),
        ("solver_regime_mismatch", F.when(F.col("regime").isNull(), at(conv("solver_regime_mismatch"))["kind"] == "null").otherwise(value(conv("solver_regime_mismatch")) == mismatch.cast("string"))),
        ("time_basis", has(conv("time_basis"))),
    ]
    means = [t for c in GATED[:3] for t in published("forces", c, c)] + published("pressure", "cp_base", "cp_base") + [t for c in COMPONENTS[:2] for t in published("forces", c, c)]
    means += [t for k, c in (("mdot_in_over_rhoUD2", "mdot_in"), ("mdot_out_over_rhoUD2", "mdot_out")) for t in published("mass", k, c, scale=scale)] + published("mass", "mass_imbalance", "mass_imbalance") + [("reference", scale.isNotNull())]
    probe = f"probes/{PROBE}"
    family_a = published("wake", "x_reattach_D", "x_reattach") + published("wake", "recirculation_length_D", "recirculation_length_D") + [
        (probe, close(F.when(pooled, F.col(f"p_{PROBE}.mean")).otherwise(F.col(f"l_{PROBE}")), number(f"{probe}/value")) & close(F.when(pooled, F.col(f"p_{PROBE}.sd")).otherwise(0.0), number(f"{probe}/sd"))),
        (f"{probe} companions", (number(f"{probe}/window_iterations") == wi) & (number(f"{probe}/n_windows") == nw) & (value(f"{probe}/statistic") == kind_mean) & (number(f"{probe}/position_D/0") == 2) & (number(f"{probe}/position_D/1") == 0) & (number(f"{probe}/position_D/2") == 0) & ~has(f"{probe}/position_D/3")),
        ("wake.note", value("wake/note") == WAKE_NOTE),
    ]
    family_b = published("pressure", "cp_min", "cp_min", "min", sd=False) + published("pressure", "cp_stagnation", "cp_stagnation", "max", sd=False)
    for p in PLANES:
        names = F.size(F.filter("all_paths", below(f"plane_extremes/{p}")))
        family_b.append((f"plane_extremes.{p} keys", names == len(FIELDS)))
        for f in FIELDS:
            lo, hi = f"LLM_{f}_min_{p}", f"LLM_{f}_max_{p}"
            family_b.append((f"plane_extremes.{p}.{f}", close(F.when(pooled, F.col(f"p_{lo}.min")).otherwise(F.col(f"l_{lo}")), number(f"plane_extremes/{p}/{f}/0")) & close(F.when(pooled, F.col(f"p_{hi}.max")).otherwise(F.col(f"l_{hi}")), number(f"plane_extremes/{p}/{f}/1"))))
    family_b.append(("plane_extremes companions", (value("plane_extremes/statistic") == F.when(pooled, "window_min_max").otherwise("instantaneous")) & (number("plane_extremes/window_iterations") == wi) & (number("plane_extremes/n_windows") == nw)))

    companion = r"^(note|statistic|window_iterations|n_windows)$|(_sd|_window_iterations|_n_windows|_statistic)$"
    whole = lambda b: F.coalesce(F.map_contains_key("s", F.concat(b["parent"], F.lit("/statistic"))), F.lit(False))
    told = lambda b: F.coalesce(F.when(b["kind"] == "object", F.map_contains_key("s", F.concat_ws("/", b["parent"], b["name"], F.lit("statistic")))).otherwise(F.map_contains_key("s", F.concat(b["parent"], F.lit("/"), b["name"], F.lit("_statistic")))), F.lit(False))
    single = F.transform(F.filter("blocks", lambda b: ~b["name"].rlike(companion) & ~whole(b) & ~told(b)), lambda b: F.concat_ws(".", b["parent"], b["name"]))
    demanded = listed(*[(p.replace("/", "."), has(p) & has(f"{p}_statistic")) for p in ("forces/cd_pressure", "forces/cd_friction", "mass/mdot_in_over_rhoUD2", "mass/mdot_out_over_rhoUD2", "mass/mass_imbalance")])
    flows = F.filter("mass_keys", lambda k: k.startswith("mdot_") & ~k.startswith("mdot_in_over_rhoUD2") & ~k.startswith("mdot_out_over_rhoUD2"))

    base = base.withColumn("all_paths", F.coalesce(F.map_keys("s"), F.array().cast("array<string>")))
    rules: list[tuple[str, Column, Column]] = [
        ("G01", F.lit(True), listed(("summary.json and one history", both), ("the history's name", ~both | (F.col("history") == F.concat(F.lit("monitor_history_re"), F.lpad(F.col("re").cast("bigint").cast("string"), 4, "0"), F.lit(".csv")))))),
        ("G02", both, listed(("header", header))),
        ("G03", both, listed(("rows", true(F.col("numeric")) & true(F.col("rows") > 0)), ("grid", F.col("regular")), ("last row", F.col("grid_last") == number(conv("iterations"))))),
        ("G04", readable, listed(*constants, *regime)),
        ("G05", readable, F.array_join(F.array_compact(F.concat(F.array(F.when(~true(status.isin(*STATUSES)), F.lit("status"))), F.col("retired"))), ", ")),
        ("G06", readable, listed(("short window", ~true(F.col("short"))), ("windows_closed", (F.col("closed") == number(conv("windows_closed"))) & (F.col("closed") <= windows.MOST)), *windows_equal)),
        ("G07", readable, listed(*gates_equal)),
        ("G08", readable, listed(("status", F.col("status") == status), ("iterations", F.col("stop") == number(conv("iterations"))), ("stop_reason", reason_fits(status, value(conv("stop_reason")))))),
        ("G09", readable, listed(("uncertainty", F.col("uncertainty").eqNullSafe(F.col("declared_uncertainty"))))),
        ("G10", readable, listed(*means)), ("G11", readable, listed(*family_a)), ("G12", readable, listed(*family_b)),
        ("G13", readable, F.when(status == "converged", "").otherwise(F.array_join(F.array_compact(F.concat(F.array(F.nullif(demanded, F.lit(""))), single)), ", "))),
        ("G14", readable, F.array_join(F.array_compact(F.concat(F.col("units"), flows, F.array(F.nullif(listed(("mdot_in_over_rhoUD2", has("mass/mdot_in_over_rhoUD2")), ("mdot_out_over_rhoUD2", has("mass/mdot_out_over_rhoUD2"))), F.lit(""))))), ", ")),
    ]
    told_all = F.array(*[F.struct(F.lit(r).alias("rule"), F.when(due, F.coalesce(bad, F.lit(""))).alias("detail")) for r, due, bad in rules])
    out = base.select("capsule", F.explode(told_all).alias("r")).select("capsule", "r.rule", "r.detail").filter("detail IS NOT NULL")
    return out.select("capsule", "rule", (F.col("detail") == "").alias("ok"), "detail")
