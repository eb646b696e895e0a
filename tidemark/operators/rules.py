"""A rule engine over artifact tables: checks are projections of one scan into findings.

``artifacts``: capsule, path, content (BINARY), length. Every JSON document is walked once into a node table, objects
and arrays included, at any depth, and that table is written once; an object's row holds its own keys as a map, so rules
that look at several keys need no shuffle. Every check yields rows (capsule, check_id, severity, message, path); no check
collects anything, and the union is one plan.

Cases: a file that is not UTF-8 or does not parse has no nodes and is reported once; a capsule without summary.json is
reported for that alone; columns besides the four are ignored; an empty table gives no findings.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

# --- fixed values of the format -----------------------------------------------------------------------------------

#: Files of the root, and what each folder may hold.
ROOT_FILES = ("setup.txt", "summary.json", "samples.csv", "features.json", "diff.json", "manifest.json", "disclosure.json")
FOLDERS = {
    "planes": r"^.+\.(csv|png)$",
    "views": r"^[a-z0-9_]+\.png$",
    "diff": r"^[a-z0-9_]+\.png$",
    "signals": r"^((phase_average|spectrum)\.csv|signals\.json)$",
    "modes": r"^(modes\.json|coefficients\.csv|modes_[A-Za-z0-9_]+\.csv|mode_\d{2,}_[A-Za-z0-9_]+\.png)$",
    "snapshots": r"^snapshot_[A-Za-z0-9_]+_p\d{2}\.png$",
}
STATUSES = ("converged", "stationary", "not_stationary", "no_steady_state")
STATISTICS = ("iteration_mean", "window_min", "window_max", "window_min_max", "instantaneous", "time_mean", "time_rms", "phase_mean")
EXTREMES = ("window_min", "window_max", "window_min_max")
WINDOWED_BLOCKS = ("forces", "pressure", "wake", "mass")
COMPANIONS = ("_sd", "_window_iterations", "_n_windows", "_statistic", "_window_tU_over_L")
ENVIRONMENT_KEYS = ("solver", "version", "build", "platform", "precision")
PRECISIONS = ("single", "double", "mixed")
REFERENCE_ROOTS = ("length", "velocity", "density", "viscosity", "pressure", "temperature", "time", "chord", "side", "diameter", "span", "area", "frequency")
LEGACY_CONTAINERS = ("references", "reference_quantities", "nondimensionalization", "nondimensionalisation", "scales")
LEGACY_UNIT_KEYS = ("unit", "units", "unit_flag", "dimensional", "flag")
NONDIMENSIONAL = (
    "ratio", "number", "coefficient", "coeff", "fraction", "exponent", "index", "nondim", "_over_", "count", "reynolds", "mach", "strouhal",
    "normalized", "normalised", "rel_error", "relative", "imbalance", "residual", "percent",
)
UNIT = r"(?:m|mm|s|kg|pa|k|n|j|w|hz)\d?"
UNIT_SUFFIX = rf"(?:_{UNIT})+(?:_per(?:_{UNIT})+)?$"
CAPITAL_UNIT = r"_(Pa|kPa|MPa|Hz|kHz)(?=_|\d|$)"
ANGLE_SUFFIX = r"_(deg|rad)$"
DISCRETIZATION = ("converged", "reduced_order", "above_order", "nominal", "not_asymptotic")
OSCILLATORY = ("converged", "nominal", "not_asymptotic")
BANDED = ("converged", "reduced_order", "above_order")
DIFF_KEYS = ("schema_version", "base", "variant", "difference", "view_contract", "pipeline", "pairs", "scalar_deltas", "known_differences")
DIFF_BASE_KEYS = ("repo", "commit", "path", "frozen_copy_path")
RELATIVE_KEYS, BASE_KEYS = ("relative", "_rel", "percent", "pct", "_frac"), ("base", "base_value", "value_base", "reference")
LONG_SIDE, LEVELS, LEAST_COLOURS, RUN_SHARE, INSTRUMENTS = 1024, 256, 8, 10, "diffsrc"
SPLIT_TOLERANCE, SUM_TOLERANCE, SIGNED_TOLERANCE, CUMULATIVE, NEARLY_ZERO = 1e-3, 1e-3, 1e-6, 0.999, 1e-9

Check = Callable[[DataFrame, DataFrame], DataFrame]
_NODE = "file string, path string, parent string, name string, depth int, kind string, value string, number double, keys map<string, struct<kind: string, value: string, number: double>>"
_PLAIN = pa.schema([("capsule", pa.string()), ("file", pa.string()), ("path", pa.string()), ("parent", pa.string()), ("name", pa.string()), ("depth", pa.int32()), ("kind", pa.string()), ("value", pa.string()), ("number", pa.float64())])
_SAID = pa.schema([("kind", pa.string()), ("value", pa.string()), ("number", pa.float64())])
#: Nodes and characters of their values that are handed on at a time.
BATCH_NODES, BATCH_CHARS = 10_000, 8 << 20


def finding(rows: DataFrame, check_id: str, severity: str, message: Column | str, path: Column | str = "path") -> DataFrame:
    said = F.lit(message) if isinstance(message, str) else message
    return rows.select("capsule", F.lit(check_id).alias("check_id"), F.lit(severity).alias("severity"), said.alias("message"), (F.col(path) if isinstance(path, str) else path).alias("path"))


def _all(*found: DataFrame) -> DataFrame:
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def texts(artifacts: DataFrame) -> DataFrame:
    """Adds text (null if not UTF-8), bom, name, folder, extension, depth."""
    parts = F.split("path", "/")
    marked = artifacts.withColumn("bom", F.substring("content", 1, 3) == F.lit(b"\xef\xbb\xbf")).withColumn("utf8", F.expr("is_valid_utf8(content)"))
    return _decoded(marked).withColumn("name", F.element_at(parts, -1)).withColumn("folder", F.when(F.size(parts) > 1, F.element_at(parts, 1)).otherwise("")).withColumn("extension", F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))).withColumn("depth", F.size(parts) - 1)


def _decoded(marked: DataFrame) -> DataFrame:
    body = F.when(F.col("bom"), F.expr("substring(content, 4)")).otherwise(F.col("content"))
    return marked.withColumn("text", F.when(F.col("utf8"), F.decode(body, "UTF-8")))


def json_leaves(docs: DataFrame, key: list[str], text: str) -> DataFrame:
    """Leaves of JSON documents at any depth: key columns, path (joined with /), name, type, value (text).

    One ``variant_explode`` per level, until no level has objects or arrays left; documents that do not parse have no
    leaves.
    """
    level = docs.select(*key, F.lit("").alias("path"), F.lit("").alias("name"), F.try_parse_json(text).alias("v")).filter(F.col("v").isNotNull())
    out: DataFrame | None = None
    inner = lambda c: F.schema_of_variant(c).startswith("OBJECT") | F.schema_of_variant(c).startswith("ARRAY")
    while out is None or not level.filter(inner("v")).isEmpty():
        name = f"_jl{id(level)}"
        level.filter(inner("v")).withColumnRenamed("v", "parent").createOrReplaceTempView(name)
        columns = ", ".join(f"t.`{k}`" for k in key)
        step = level.sparkSession.sql(f"SELECT {columns}, concat(t.path, CASE WHEN t.path = '' THEN '' ELSE '/' END, coalesce(e.key, cast(e.pos AS string))) AS path, coalesce(e.key, cast(e.pos AS string)) AS name, e.value AS v FROM {name} t, LATERAL variant_explode(t.parent) AS e")
        leaves = step.filter(~inner("v"))
        out = leaves if out is None else out.unionByName(leaves)
        level = step
    return out.select(*key, "path", "name", F.schema_of_variant("v").alias("type"), F.col("v").cast("string").alias("value"))


_KINDS = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}


def _said(value: object) -> tuple[str, str | None, float | None]:
    """kind, value and number of a node."""
    kind = _KINDS.get(type(value), "number")
    if kind == "string":
        return kind, value, None
    if kind in ("object", "array"):
        return kind, None, None
    return kind, json.dumps(value), float(value) if kind == "number" and abs(value) < 1e308 else None


class _Nodes:
    """Nodes of documents by columns, until they are handed on; an object also tells what its keys hold."""

    def __init__(self) -> None:
        self.document, self.plain, self.ends, self.keys = [], [[] for _ in range(7)], [0], [[] for _ in range(4)]

    def add(self, document: int, node: tuple, keys: list[tuple] = ()) -> None:
        """``node``: path, parent, name, depth, kind, value, number; ``keys``: name, kind, value and number of each."""
        self.document.append(document)
        for column, v in zip(self.plain, node):  # noqa: B905
            column.append(v)
        for k in keys:
            for column, v in zip(self.keys, k):  # noqa: B905
                column.append(v)
        self.ends.append(len(self.keys[0]))

    def walk(self, document: int, value: object) -> None:
        """All nodes of a parsed document, without recursion, each before its children."""
        stack = [(value, ("", "", "", 0, *_said(value)))]
        while stack:
            value, node = stack.pop()
            path, depth, kind = node[0], node[3] + 1, node[4]
            if kind not in ("object", "array"):
                self.add(document, node)
                continue
            start = f"{path}/" if path else ""
            kids = [(v, (f"{start}{k}", path, str(k), depth, *_said(v))) for k, v in (value.items() if kind == "object" else enumerate(value))]
            self.add(document, node, [(n[2], *n[4:]) for _, n in kids] if kind == "object" else ())
            kids.reverse()
            stack += kids

    def batch(self, docs: pa.RecordBatch) -> pa.RecordBatch:
        of = pa.array(self.document, pa.int32())
        columns = [docs.column(c).take(of).cast(pa.string()) for c in ("capsule", "file")] + [pa.array(c, t) for c, t in zip(self.plain, _PLAIN.types[2:], strict=True)]
        values = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(self.keys[1:], _SAID.types, strict=True)], fields=list(_SAID))
        keys = pa.MapArray.from_arrays(pa.array(self.ends, pa.int32()), pa.array(self.keys[0], pa.string()), values)
        return pa.record_batch([*columns, keys], [*_PLAIN.names, "keys"])


def json_nodes(docs: DataFrame) -> DataFrame:
    """All nodes of the documents (capsule, file, text): capsule, file, path, parent, name, depth, kind, value, number, keys.

    ``keys`` holds kind, value and number of each key of an object, and is empty elsewhere. Python's parser tells line and
    column of an error, which is the only node (kind ``error``) of a broken document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, chars = _Nodes(), 0
            for i, text in enumerate(batch.column("text").to_pylist()):
                try:
                    nodes.walk(i, json.loads(text))
                except (ValueError, RecursionError) as e:
                    where = f"line {e.lineno} column {e.colno}: {e.msg}" if isinstance(e, json.JSONDecodeError) else str(e)
                    nodes.add(i, ("", "", "", 0, "error", where, None))
                chars += len(text)
                if len(nodes.document) >= BATCH_NODES or chars >= BATCH_CHARS:
                    yield nodes.batch(batch)
                    nodes, chars = _Nodes(), 0
            if nodes.document:
                yield nodes.batch(batch)

    return docs.select("capsule", "file", "text").mapInArrow(run, f"capsule string, {_NODE}")


# --- words about keys ----------------------------------------------------------------------------------------------


def unit_suffix(name: Column) -> Column:
    """Whether a key ends in a unit."""
    return name.rlike(UNIT_SUFFIX)


def nondimensional(name: Column) -> Column:
    """Whether a key calls itself a group, a ratio or a coefficient."""
    return F.lower(name).rlike("|".join(NONDIMENSIONAL))


def reference_key(name: Column) -> Column:
    return F.lower(name).rlike(f"^({'|'.join(REFERENCE_ROOTS)})") & ~nondimensional(name)


def is_angle(name: Column) -> Column:
    return F.lower(name).rlike(ANGLE_SUFFIX)


def snake_case(name: Column) -> Column:
    return name.rlike("^[a-z][a-z0-9]*(_[a-z0-9]+)*$")


def commit_kind(sha: Column) -> Column:
    """full, short or none: whether a text looks like a commit."""
    return F.when(sha.rlike("^[0-9a-f]{40}$"), "full").when(sha.rlike("^[0-9a-f]{7,39}$"), "short").otherwise("none")


def is_sha256(value: Column) -> Column:
    return F.coalesce(F.lower(value).rlike("^[0-9a-f]{64}$"), F.lit(False))


def objects(nodes: DataFrame) -> DataFrame:
    """One row per object: capsule, file, path, up (its parent), key (its name), keys (name to kind, value, number)."""
    return nodes.filter(F.col("kind") == "object").select("capsule", "file", "path", F.col("parent").alias("up"), F.col("name").alias("key"), "keys")


def _has(key: str | Column) -> Column:
    return F.map_contains_key("keys", F.lit(key) if isinstance(key, str) else key)


def _get(key: str | Column) -> Column:
    return F.try_element_at("keys", F.lit(key) if isinstance(key, str) else key)


def _number(key: str | Column) -> Column:
    return F.coalesce(_get(key)["kind"] == "number", F.lit(False))


def _of(nodes: DataFrame, file: str, path: str | None = None) -> DataFrame:
    rows = nodes.filter(F.col("file") == file)
    return rows if path is None else rows.filter(F.col("path") == path)


def _missing(*tests: tuple[Column, Column | str]) -> Column:
    """The labels of the tests that fail, joined."""
    return F.array_join(F.filter(F.array(*[F.when(~ok, F.lit(label) if isinstance(label, str) else label) for ok, label in tests]), lambda x: x.isNotNull()), ", ")


# --- checks: (artifacts with texts, nodes) -> findings ----------------------------------------------------------------


def root_name(a: DataFrame, nodes: DataFrame) -> DataFrame:
    bad = a.select("capsule").distinct().withColumn("path", F.col("capsule"))
    return _all(finding(bad.filter(~F.col("capsule").startswith("capsule_")), "root", "E", "the folder is not named capsule_<alias>"), finding(bad.filter(F.col("capsule") == "capsule_"), "root", "E", "the alias is empty"))


def required_files(a: DataFrame, nodes: DataFrame) -> DataFrame:
    wanted = F.array(F.lit("setup.txt"), F.lit("summary.json"))
    lost = a.groupBy("capsule").agg(F.collect_set(F.when(F.col("path").isin("setup.txt", "summary.json"), F.col("path"))).alias("have")).select("capsule", F.explode(F.array_except(wanted, "have")).alias("path"))
    return finding(lost, "required_files", "E", "a required file is missing")


def declared_files(a: DataFrame, nodes: DataFrame) -> DataFrame:
    pattern = F.element_at(F.create_map(*[F.lit(x) for kv in FOLDERS.items() for x in kv]), F.col("folder"))
    said = (
        F.when((F.col("depth") == 0) & ~F.col("path").isin(*ROOT_FILES), "the root does not hold this file")
        .when(F.col("depth") > 1, "nested deeper than one folder")
        .when((F.col("depth") == 1) & ~F.col("folder").isin(*FOLDERS), "the format has no such folder")
        .when((F.col("depth") == 1) & ~F.rlike(F.col("name"), pattern), "the name does not fit its folder")
    )
    return finding(a.withColumn("said", said).filter("said IS NOT NULL"), "declared_files", "E", F.col("said"))


def not_empty(a: DataFrame, nodes: DataFrame) -> DataFrame:
    return finding(a.filter(F.col("length") == 0), "not_empty", "E", "the file is empty")


def encoding(a: DataFrame, nodes: DataFrame) -> DataFrame:
    return finding(a.filter(F.col("extension").isin("json", "txt", "csv", "java", "md") & ~F.col("utf8")), "encoding", "E", "the text is not UTF-8")


def setup_notation(a: DataFrame, nodes: DataFrame) -> DataFrame:
    from tidemark.operators.text import NOTATION, decode_column, has_marks

    setups = a.filter((F.col("path") == "setup.txt") & F.col("text").isNotNull()).select("capsule", "path", "text")
    compact = F.col("text").startswith(NOTATION[:26])
    broken = decode_column(setups.filter(compact)).filter(F.col("error").isNotNull())
    return _all(finding(broken, "setup_notation", "E", F.col("error")), finding(setups.filter(~compact & has_marks(F.col("text"))), "setup_notation", "W", "marks of the compact notation without its header"))


def json_parses(a: DataFrame, nodes: DataFrame) -> DataFrame:
    files = a.filter((F.col("extension") == "json") & F.col("utf8"))
    return _all(finding(nodes.filter(F.col("kind") == "error"), "json_parses", "E", F.concat(F.lit("not JSON at "), "value"), "file"), finding(files.filter("bom"), "json_parses", "W", "starts with a byte order mark"))


def environment(a: DataFrame, nodes: DataFrame) -> DataFrame:
    top = objects(_of(nodes, "summary.json")).filter(F.col("path") == "")
    own = objects(_of(nodes, "summary.json")).filter(F.col("path") == "environment")
    renders = objects(_of(nodes, "summary.json")).filter(F.col("path") == "environment/renders")
    bad_precision = _has("precision") & ~F.coalesce(_get("precision")["value"].isin(*PRECISIONS), F.lit(False))
    scope = _of(nodes, "summary.json").filter(F.col("parent") == "environment/renders/scope").withColumn("named", F.regexp_replace(F.coalesce("value", F.lit("")), "^/+|/+$", ""))
    folders = a.filter(F.col("folder") != "").select(F.col("capsule").alias("c"), F.col("folder").alias("f")).distinct()
    plain = (F.col("kind") == "string") & (F.col("named") != "") & ~F.col("named").contains("/") & ~F.col("named").contains("..")
    gone = scope.filter(plain).join(folders, (F.col("capsule") == F.col("c")) & (F.col("named") == F.col("f")), "left_anti")
    say = lambda rows, said, path="file": finding(rows, "environment", "W", said, path)
    return _all(
        say(top.filter(_has("numerics")), "numerics belongs to environment"),
        say(top.filter(~_has("environment")), "no environment block"),
        say(top.filter(_has("environment") & (_get("environment")["kind"] != "object")), "environment is not an object"),
        say(own.withColumn("lost", _missing(*[(_has(k), k) for k in ENVIRONMENT_KEYS])).filter("lost <> ''"), F.concat(F.lit("environment lacks "), "lost")),
        say(_all(own, renders).filter(bad_precision), "not a precision", "path"),
        say(own.filter(_has("renders") & (_get("renders")["kind"] != "object")), "renders is not an object"),
        say(renders.filter(~F.coalesce(_get("scope")["kind"] == "array", F.lit(False))), "renders lists no folders"),
        say(scope.filter(~plain), "not a folder of the capsule", "path"), say(gone, "the folder is not there", "path"),
    )


def _windowed(nodes: DataFrame) -> DataFrame:
    """Capsules whose status asks for windows."""
    return _of(nodes, "summary.json", "convergence/status").filter(F.coalesce(F.col("value") != "converged", F.lit(True))).select("capsule").distinct()


def window_entries(nodes: DataFrame) -> DataFrame:
    """Published scalars of a run with their companions: capsule, file, path, keys, prefix (of the companions), windowed."""
    every = objects(_of(nodes, "summary.json"))
    named = every.filter((F.col("up") == "") & F.col("key").isin(*WINDOWED_BLOCKS)).select("capsule", "file", "path", "keys", F.explode(F.map_keys("keys")).alias("name"))
    stem = F.coalesce(*[F.when(F.col("name").endswith(s), F.expr(f"substring(name, 1, length(name) - {len(s)})")) for s in sorted(COMPANIONS, key=len, reverse=True)], F.lit(None).cast("string"))
    values = named.filter(_number(F.col("name")) & ~F.coalesce(F.map_contains_key("keys", F.coalesce(stem, F.lit(""))), F.lit(False)))
    rows = values.select("capsule", "file", F.concat_ws("/", "path", "name").alias("path"), "keys", F.concat("name", F.lit("_")).alias("prefix"))
    probes = every.filter(F.col("up") == "probes").select("capsule", "file", "path", "keys", F.lit("").alias("prefix"))
    due = _windowed(nodes).withColumn("windowed", F.lit(True))
    return rows.unionByName(probes).join(due, "capsule", "left").withColumn("windowed", F.coalesce("windowed", F.lit(False)))


def _window_findings(nodes: DataFrame) -> DataFrame:
    e = window_entries(nodes)
    key = lambda s: F.concat("prefix", F.lit(s))
    statistic = _get(key("statistic"))["value"]
    e = e.withColumn("bare", _missing(((statistic != "iteration_mean") | statistic.isNull() | _has(key("sd")), "sd"), (_has(key("window_iterations")) | _has(key("window_tU_over_L")), "a window"), (_has(key("n_windows")), "n_windows"), (_has(key("statistic")), "statistic")))
    say = lambda rows, said: finding(rows, "summary_blocks", "W", said)
    return _all(
        say(e.filter(_has(key("statistic")) & ~F.coalesce(statistic.isin(*STATISTICS), F.lit(False))), "not a statistic"),
        say(e.filter(F.coalesce(statistic.isin(*EXTREMES), F.lit(False)) & _has(key("sd"))), "an extreme has no sd"),
        say(e.filter("windowed AND bare <> ''"), F.concat(F.lit("a windowed value without "), "bare")),
        say(e.filter((F.col("prefix") == "") & F.col("windowed") & ~_has("value")), "a probe without a value"),
    )


def _mesh_findings(nodes: DataFrame) -> DataFrame:
    mesh = objects(_of(nodes, "summary.json"))
    whole = lambda k: _number(k) & (F.floor(_get(k)["number"]) == _get(k)["number"]) & ~_get(k)["value"].rlike("[.eE]")
    m, wall = mesh.filter(F.col("path") == "mesh"), mesh.filter(F.col("path") == "mesh/wall")
    span = _of(nodes, "summary.json").filter(F.col("parent") == "mesh/designed_for_Re_range").groupBy("capsule", "file").agg(F.count(F.lit(1)).alias("n"), F.bool_and((F.col("kind") == "number") & ~F.col("value").rlike("[.eE]")).alias("whole"), F.max_by("number", F.col("name").cast("int")).alias("high"), F.min_by("number", F.col("name").cast("int")).alias("low"))
    layers = wall.select("capsule", "file", "path", F.explode("keys").alias("key", "v")).filter(F.col("key").startswith("first_layer_"))
    say = lambda rows, said, path="file": finding(rows, "summary_blocks", "W", said, path)
    return _all(
        say(m.filter(_has("cells") & ~whole("cells")), "mesh/cells is not an integer"),
        say(m.filter(_has("designed_for_Re")), "designed_for_Re is replaced by a range"),
        say(span.filter((F.col("n") != 2) | ~F.col("whole") | (F.col("low") > F.col("high"))), "the range of Re is not two integers, low then high"),
        say(wall.withColumn("lost", _missing((_has("layers"), "layers"), (_has("layer_coverage"), "layer_coverage"))).filter("lost <> ''"), F.concat(F.lit("mesh/wall lacks "), "lost")),
        say(wall.filter(_has("layers") & ~(whole("layers") & (_get("layers")["number"] >= 0))), "layers is not a count"),
        say(wall.filter(_has("layer_coverage") & ~F.coalesce(_get("layer_coverage")["number"].between(0, 1), F.lit(False))), "layer_coverage is not a share"),
        say(layers.filter(~F.coalesce(F.col("v")["number"] > 0, F.lit(False))), "not a positive height", "path"),
    )


def _discretization_findings(nodes: DataFrame) -> DataFrame:
    q = objects(_of(nodes, "summary.json")).filter(F.col("up") == "discretization/space/quantities")
    space = objects(_of(nodes, "summary.json")).filter(F.col("path") == "discretization/space")
    status, behaviour = F.coalesce(_get("status")["value"], F.lit("")), F.coalesce(_get("behaviour")["value"], F.lit(""))
    banded = q.filter((behaviour == "monotone") & status.isin(*BANDED)).select("capsule").distinct()
    size = _of(nodes, "summary.json").filter(F.col("parent").isin("discretization/space/family", "discretization/space/iteration_error")).groupBy("capsule", "file").pivot("parent", ["discretization/space/family", "discretization/space/iteration_error"]).agg(F.count(F.lit(1))).toDF("capsule", "file", "family", "errors")
    say = lambda rows, said, path="path": finding(rows, "summary_blocks", "W", said, path)
    return _all(
        say(size.filter("errors IS NOT NULL AND family IS NOT NULL AND errors <> family"), "one iteration error per mesh", "file"),
        say(space.join(banded, "capsule", "left_semi").filter(~_has("order_band")), "no order_band"),
        say(q.filter(~status.isin(*DISCRETIZATION)), "not a status of a discretization"),
        say(q.filter((status == "not_asymptotic") & (_has("extrapolated") | _has("gci_fine"))), "not asymptotic, yet extrapolated"),
        say(q.filter((status == "above_order") & _has("extrapolated")), "above order, yet extrapolated"),
        say(q.filter((status == "above_order") & ~_has("gci_order")), "above order without gci_order"),
        say(q.filter((behaviour == "oscillatory") & _has("extrapolated")), "oscillatory, yet extrapolated"),
        say(q.filter((behaviour == "oscillatory") & status.isin(*DISCRETIZATION) & ~status.isin(*OSCILLATORY)), "not a status of an oscillation"),
        say(q.filter((status == "reduced_order") & ~F.coalesce(_get("assumed")["value"] == "true", F.lit(False))), "reduced order without assumed"),
    )


def split_parts(nodes: DataFrame) -> DataFrame:
    """Coefficients that are published with their parts, and the gap between them."""
    o = objects(_of(nodes, "summary.json")).select("capsule", "file", F.col("path").alias("block"), "keys", F.explode(F.map_keys("keys")).alias("name"))
    part = lambda s: _get(F.concat("name", F.lit(s)))
    whole = o.filter(_number(F.col("name")) & _number(F.concat("name", F.lit("_pressure"))) & _number(F.concat("name", F.lit("_friction"))))
    normal = F.coalesce(part("_viscous_normal")["number"], F.lit(0.0))
    value = _get(F.col("name"))["number"]
    return whole.withColumn("value", value).withColumn("gap", value - part("_pressure")["number"] - part("_friction")["number"] - normal).withColumn("path", F.concat_ws("/", F.nullif("block", F.lit("")), "name"))


def summary_blocks(a: DataFrame, nodes: DataFrame) -> DataFrame:
    s = _of(nodes, "summary.json")
    every = objects(s)
    top, unsure = every.filter(F.col("path") == ""), every.filter(F.col("path") == "convergence/uncertainty")
    status = s.filter((F.col("path") == "convergence/status") & ~F.coalesce(F.col("value").isin(*STATUSES), F.lit(False)))
    extremes = every.filter(F.col("path") == "plane_extremes")
    once = _missing((_has("statistic"), "statistic"), (_has("window_iterations") | _has("window_tU_over_L"), "a window"), (_has("n_windows"), "n_windows"))
    flows = s.filter((F.col("parent") == "mass") & F.lower("name").startswith("mdot") & ~F.lower("name").contains("_over_"))
    say = lambda rows, said, path="path": finding(rows, "summary_blocks", "W", said, path)
    return _all(
        say(status, "not a status"),
        say(top.filter(_has("uncertainty")), "uncertainty belongs inside convergence", "file"),
        say(extremes.filter(_has("statistic") & ~F.coalesce(_get("statistic")["value"].isin(*STATISTICS), F.lit(False))), "not a statistic"),
        say(extremes.join(_windowed(nodes), "capsule", "left_semi").withColumn("lost", once).filter("lost <> ''"), F.concat(F.lit("the extremes lack "), "lost")),
        say(flows, "a dimensional mass flow"),
        say(unsure.filter(~_number("cd_relative")), "cd_relative is not a number"),
        say(unsure.filter(~F.coalesce(_get("basis")["kind"] == "string", F.lit(False))), "no basis"),
        say(unsure.filter(~F.coalesce(_get("source")["value"].isin("measured", "declared"), F.lit(False))), "not a source of uncertainty"),
        say(split_parts(nodes).filter(F.abs("gap") > SPLIT_TOLERANCE * F.abs("value")), "the parts do not close"),
        _window_findings(nodes), _mesh_findings(nodes), _discretization_findings(nodes),
    )


def plane_pairs(a: DataFrame, nodes: DataFrame) -> DataFrame:
    from tidemark.operators.diff import unpaired_stems

    inside = a.filter(F.col("folder") == "planes")
    planes = inside.filter((F.col("depth") == 1) & F.col("extension").isin("csv", "png")).withColumn("stem", F.regexp_extract("path", r"^(.*)\.[^.]*$", 1))
    lost = unpaired_stems(planes, ["capsule"], "stem", "extension", ("csv", "png"))
    return _all(
        finding(inside.filter(~F.col("extension").isin("csv", "png")), "plane_pairs", "E", "neither CSV nor PNG"),
        finding(inside.filter(~F.col("name").rlike(r"^plane_.+")), "plane_pairs", "E", "not named plane_<id>"),
        finding(lost, "plane_pairs", "E", F.concat(F.lit("no "), F.col("missing"), F.lit(" beside it")), "stem"),
    )


def csv_header(a: DataFrame, nodes: DataFrame) -> DataFrame:
    planes = a.filter((F.col("folder") == "planes") & (F.col("extension") == "csv") & F.col("text").isNotNull()).withColumn("head", F.element_at(F.split("text", "\r\n|\r|\n"), 1))
    commented = planes.filter(F.col("head").startswith("#")).withColumn("parts", F.split("head", r"\|"))
    some = lambda test: F.exists("parts", test)
    lost = _missing((some(lambda p: p.rlike(r"grid\s")), "grid"), (some(lambda p: p.contains("spacing")), "spacing"), (some(lambda p: p.rlike(r"\d+\s+of\s+\d+\s+nodes")), "nodes of nodes"), (some(lambda p: p.contains("%")), "precision"))
    return _all(
        finding(planes.filter(~F.col("head").startswith("#")), "csv_header", "E", "no comment header"),
        finding(commented.filter(~F.lower("head").contains("nondimensional")), "csv_header", "E", "the header does not say nondimensional"),
        finding(commented.withColumn("lost", lost).filter("lost <> ''"), "csv_header", "W", F.concat(F.lit("the header omits "), "lost")),
    )


def _u32(at: int) -> Column:
    return F.conv(F.hex(F.expr(f"substring(content, {at}, 4)")), 16, 10).cast("bigint")


def png_geometry(a: DataFrame, nodes: DataFrame) -> DataFrame:
    pngs = a.filter(F.col("extension") == "png").withColumn("side", F.greatest(_u32(17), _u32(21)))
    real = (F.substring("content", 1, 8) == F.lit(b"\x89PNG\r\n\x1a\n")) & (F.col("length") >= 24)
    return _all(finding(pngs.filter(~real), "png_geometry", "E", "not a PNG"), finding(pngs.filter(real & (F.col("side") != LONG_SIDE)), "png_geometry", "E", F.concat(F.lit("the long side is "), F.col("side").cast("string"))))


def png_metadata(a: DataFrame, nodes: DataFrame) -> DataFrame:
    from tidemark.sources.images import png_chunks

    chunks = png_chunks(a.filter(F.col("extension") == "png").select("capsule", "path", "content"))
    return finding(chunks.filter(F.exists("chunks", lambda c: c.isin("eXIf", "tEXt", "iTXt", "zTXt"))), "png_metadata", "E", "the picture carries text or EXIF")


def view_field(a: DataFrame, nodes: DataFrame) -> DataFrame:
    """Levels that the manifest declares for a view lower the number of colours that it needs."""
    from tidemark.sources.images import richest_run

    views = a.filter((F.col("extension") == "png") & (F.col("folder") == "views")).select("capsule", "path", "content")
    manifest = _of(nodes, "manifest.json")
    named = manifest.filter((F.col("name") == "file") & F.col("parent").rlike(r"^views/\d+$")).select("capsule", F.col("value").alias("path"), F.col("parent").alias("entry"))
    bars = manifest.filter(F.col("path").rlike(r"^views/\d+/(recipe/)?colorbar/levels$") & (F.col("kind") == "number") & (F.col("number") > 0)).select("capsule", F.regexp_extract("path", r"^(views/\d+)/", 1).alias("entry"), "number")
    declared = named.join(bars, ["capsule", "entry"]).groupBy("capsule", "path").agg(F.min("number").alias("levels"))
    seen = richest_run(views).join(declared, ["capsule", "path"], "left")
    narrow = F.col("longest") < F.floor(F.col("width") / RUN_SHARE)
    return _all(
        finding(seen.filter(F.col("error").isNotNull()), "view_field", "W", F.col("error")),
        finding(seen.filter(narrow & ~F.col("path").rlike(r"_diff\.png$")), "view_field", "W", "no stretch without background reaches a tenth of the width"),
        finding(seen.filter(~narrow & (F.col("colours") < F.least(F.lit(LEAST_COLOURS), F.coalesce("levels", F.lit(LEAST_COLOURS))))), "view_field", "W", F.concat(F.lit("no field: colours on a stretch at most "), F.col("colours").cast("string"))),
    )


def signed_range(a: DataFrame, nodes: DataFrame) -> DataFrame:
    bars = objects(_of(nodes, "manifest.json")).filter((F.col("key") == "colorbar") & _has("signed"))
    ends = _of(nodes, "manifest.json").filter(F.col("parent").endswith("colorbar/range")).groupBy("capsule", F.regexp_replace("parent", "/range$", "").alias("path")).agg(F.count(F.lit(1)).alias("n"), F.count("number").alias("numbers"), F.min_by("number", F.col("name").cast("int")).alias("low"), F.max_by("number", F.col("name").cast("int")).alias("high"))
    signed = bars.filter(_get("signed")["value"] == "true").join(ends, ["capsule", "path"], "left")
    whole = F.coalesce((F.col("n") == 2) & (F.col("numbers") == 2), F.lit(False))
    even = (F.col("low") < 0) & (F.col("high") > 0) & (F.abs(F.col("low") + F.col("high")) <= SIGNED_TOLERANCE * (F.col("high") - F.col("low")) / 2)
    say = lambda rows, said: finding(rows, "signed_range", "W", said)
    return _all(say(bars.filter(_get("signed")["kind"] != "boolean"), "signed is not true or false"), say(signed.filter(~whole), "signed without a range"), say(signed.filter(whole & ~even), "a signed colour bar is not symmetric"))


def transient_layers(a: DataFrame, nodes: DataFrame) -> DataFrame:
    """Periods agree with their window; energy fractions run up to their cumulative values, and reach 0.999."""
    signals = objects(_of(nodes, "signals/signals.json"))
    period = signals.filter(F.col("path") == "period_tU_over_L")
    window = _of(nodes, "signals/signals.json").filter(F.col("parent") == "window_tU_over_L").groupBy("capsule").agg(F.min("number").alias("t0"), F.max("number").alias("t1"))
    top = signals.filter(F.col("path") == "").select("capsule", _get("n_periods")["number"].alias("n"))
    timed = period.join(window, "capsule", "left").join(top, "capsule", "left").withColumn("given", (F.col("t1") - F.col("t0")) / F.col("n"))
    modes = objects(_of(nodes, "modes/modes.json"))
    table = modes.filter(F.col("up") == "modes").select("capsule", "file", "path", F.col("key").cast("int").alias("i"), _get("energy_fraction")["number"].alias("share"), _get("cumulative")["number"].alias("upto"))
    order = Window.partitionBy("capsule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    run = table.withColumn("sum", F.sum("share").over(order))
    end = table.groupBy("capsule", "file").agg(F.max("upto").alias("most"), F.sum("share").alias("total"))
    folder = a.filter(F.col("folder") == "modes").groupBy("capsule").agg(F.bool_or(F.col("path") == "modes/modes.json").alias("have"))
    head = modes.filter(F.col("path") == "")
    periods = head.select("capsule", "file", _get("n_periods")["number"].alias("m")).join(top, "capsule")
    say = lambda rows, said, path="file": finding(rows, "transient_layers", "W", said, path)
    return _all(
        say(timed.withColumn("lost", _missing((_has("mean"), "mean"), (_has("sd"), "sd"))).filter("lost <> ''"), F.concat(F.lit("the period lacks "), "lost"), "path"),
        say(timed.filter(F.abs(_get("mean")["number"] - F.col("given")) > SUM_TOLERANCE * F.abs("given")), "the period is not that of its window", "path"),
        say(timed.filter(_get("sd")["number"] < 0), "a negative sd", "path"),
        say(folder.filter(~F.col("have")).withColumn("file", F.lit("modes")), "no modes.json"),
        say(head.filter(~F.coalesce(_get("modes")["kind"] == "array", F.lit(False))), "no table of modes"),
        say(head.filter(_has("total_energy") & ~F.coalesce(_get("total_energy")["number"] > 0, F.lit(False))), "total_energy is not positive"),
        say(table.filter(~F.coalesce(F.col("share").between(0, 1), F.lit(False))), "an energy fraction is not a share", "path"),
        say(run.filter(F.abs(F.col("sum") - F.col("upto")) > SUM_TOLERANCE), "cumulative is not the running sum", "path"),
        say(end.filter(F.col("total") > 1 + SUM_TOLERANCE), "more than all of the energy"), say(end.filter(F.col("most") < CUMULATIVE - SUM_TOLERANCE), "the modes stop short of 0.999"),
        say(periods.filter(F.col("m") != F.col("n")), "periods differ from those of the signals"),
    )


def reference_block(a: DataFrame, nodes: DataFrame) -> DataFrame:
    s = _of(nodes, "summary.json")
    block = (F.col("kind") == "object") & F.lower("name").isin("reference", *LEGACY_CONTAINERS)
    single = reference_key(F.col("name")) & ((F.col("kind") == "number") | unit_suffix(F.col("name")) | (F.col("kind") == "object"))
    have = s.filter(block | single).select("capsule").distinct()
    return finding(s.filter((F.col("path") == "") & (F.col("kind") == "object")).join(have, "capsule", "left_anti"), "reference_block", "E", "there is no reference quantity", "file")


def dimensional_flags(a: DataFrame, nodes: DataFrame) -> DataFrame:
    n = nodes.filter((F.col("depth") > 0) & ~F.col("name").rlike(r"^\d+$") & ~is_angle(F.col("name")))
    head = F.lower(F.element_at(F.split("path", "/"), 1))
    inside = (head == "reference") & (F.col("parent") != "")
    trail = F.split(F.lower("parent"), "/")
    legacy = F.arrays_overlap(trail, F.array(*map(F.lit, LEGACY_CONTAINERS)))
    flagged = objects(nodes).filter((F.col("key") != "") & F.exists(F.map_keys("keys"), lambda k: F.lower(k) == "value") & F.exists(F.map_keys("keys"), lambda k: F.lower(k).isin(*LEGACY_UNIT_KEYS)))
    said = (
        F.when(unit_suffix(F.col("name")) & (F.col("kind") == "number") & ~inside & ~nondimensional(F.col("name")), "a dimensional key outside the reference block")
        .when((F.col("kind") == "number") & inside & F.col("name").rlike(CAPITAL_UNIT), "a unit in capitals")
        .when((F.col("kind") == "number") & ~F.arrays_overlap(trail, F.array(*map(F.lit, LEGACY_UNIT_KEYS))) & (inside | legacy) & reference_key(F.col("name")) & ~unit_suffix(F.col("name")), "a reference quantity without a unit")
    )
    where = F.concat_ws("#", "file", "path")
    return _all(finding(n.withColumn("said", said).filter("said IS NOT NULL"), "dimensional_flags", "W", F.col("said"), where), finding(flagged, "dimensional_flags", "W", "a value with a unit beside it", where))


def extensions(a: DataFrame, nodes: DataFrame) -> DataFrame:
    said = _of(nodes, "summary.json").filter(F.col("parent") == "extensions")
    listed = _of(nodes, "summary.json", "extensions").filter(F.col("kind") != "array")
    have = a.groupBy("capsule").agg(F.bool_or(F.col("path") == "diff.json").alias("manifest"), F.bool_or(F.col("folder") == "diff").alias("pictures"))
    diff = said.filter(F.col("value") == "diff").select("capsule").distinct().withColumn("said", F.lit(True))
    both = have.join(diff, "capsule", "left").withColumn("path", F.lit("summary.json"))
    twice = said.groupBy("capsule", "file", "value").count().filter("count > 1")
    say = lambda rows, text, path="path": finding(rows, "extensions", "E", text, path)
    return _all(
        say(listed, "extensions is not an array"), say(said.filter(F.col("kind") != "string"), "not the name of an extension"),
        say(said.filter((F.col("kind") == "string") & (F.col("value") != "diff")), "an unknown extension"), say(twice, "declared more than once", "file"),
        say(both.filter("said AND NOT manifest"), "diff is declared, diff.json is missing"), say(both.filter("said AND NOT pictures"), "diff is declared, diff/ is missing"),
        say(both.filter("said IS NULL AND manifest"), "diff.json is not declared"), say(both.filter("said IS NULL AND pictures"), "diff/ is not declared"),
    )


def no_instrument_dir(a: DataFrame, nodes: DataFrame) -> DataFrame:
    return finding(a.filter(F.array_contains(F.split("path", "/"), INSTRUMENTS)), "no_instrument_dir", "E", "the instrument's renders never ship")


def diff_manifest(a: DataFrame, nodes: DataFrame) -> DataFrame:
    d = _of(nodes, "diff.json")
    every = objects(d)
    at = lambda path: every.filter(F.col("path") == path)
    top, base, contract, pipeline, pairs = at(""), at("base"), at("view_contract"), at("pipeline"), every.filter(F.col("up") == "pairs")
    commit = commit_kind(F.coalesce(_get("commit")["value"], F.lit("")))
    held = a.filter(F.col("folder") == "diff").select(F.col("capsule").alias("c"), F.col("path").alias("p"))
    output = F.coalesce(F.when(_get("output")["kind"] == "string", _get("output")["value"]), F.lit(""))
    named = pairs.withColumn("output", F.when(output.contains("/"), output).otherwise(F.concat(F.lit("diff/"), output)))
    lost = named.filter((output != "") & F.col("output").startswith("diff/")).join(held, (F.col("capsule") == F.col("c")) & (F.col("output") == F.col("p")), "left_anti")
    view = lambda side: F.coalesce(F.when(_get(side)["kind"] == "string", _get(side)["value"]), F.lit(""))
    zero = every.filter(F.col("path").startswith("scalar_deltas"))
    near_zero = lambda v: (v["kind"] == "number") & (F.abs(v["number"]) < NEARLY_ZERO)
    based = F.map_filter("keys", lambda k, v: (F.lower(k).isin(*BASE_KEYS) | F.lower(k).endswith("_base") | F.lower(k).startswith("base_")) & near_zero(v))
    told = F.map_filter("keys", lambda k, v: F.lower(k).rlike("|".join(RELATIVE_KEYS)) & ~v["kind"].isin("object", "array", "null"))
    E = lambda rows, said, path="path": finding(rows, "diff_manifest", "E", said, path)  # noqa: E731, N806
    W = lambda rows, said, path="path": finding(rows, "diff_manifest", "W", said, path)  # noqa: E731, N806
    return _all(
        E(top.withColumn("lost", _missing(*[(_has(k), k) for k in DIFF_KEYS])).filter("lost <> ''"), F.concat(F.lit("missing: "), "lost"), "file"),
        E(top.withColumn("odd", _missing(*[(~_has(k) | (_get(k)["kind"] == t), k) for k, t in (("base", "object"), ("view_contract", "object"), ("pipeline", "object"), ("pairs", "array"), ("scalar_deltas", "object"), ("known_differences", "array"))])).filter("odd <> ''"), F.concat(F.lit("not of their kind: "), "odd"), "file"),
        E(base.filter(~_has("alias") & ~_has("capsule")), "the base has no name"),
        E(base.withColumn("lost", _missing(*[(_has(k), k) for k in DIFF_BASE_KEYS])).filter("lost <> ''"), F.concat(F.lit("the base lacks "), "lost")),
        E(base.filter(_has("commit") & (commit == "none")), "not a commit"), W(base.filter(_has("commit") & (commit == "short")), "an abbreviated commit"),
        E(contract.filter(~F.coalesce(_get("colorbar_levels")["number"] == LEVELS, F.lit(False))), "not 256 levels"),
        W(contract.filter(_has("colormap_measured") & ~F.coalesce(_get("colormap_measured")["value"] == "grayscale", F.lit(False))), "not measured in grey"),
        E(pipeline.filter(~_number("pixels_evaluated")), "no count of pixels"),
        E(d.filter((F.col("parent") == "pairs") & (F.col("kind") != "object")), "a pair is not an object"),
        E(pairs.filter(~_number("threshold_physical")), "the threshold is not a number"),
        E(pairs.filter(~F.coalesce(_get("threshold_comparison")["value"].isin(">=", ">"), F.lit(False))), "not a comparison"),
        E(pairs.filter(output == ""), "no output"), E(named.filter((output != "") & ~F.col("output").startswith("diff/")), "the output lies outside diff/"), E(lost, "the output is not there"),
        *[E(pairs.filter((view(s) == "") | view(s).contains("/") | ~view(s).rlike(r"^[a-z0-9_]+\.png$")), f"{s} is not the name of a view") for s in ("base_view", "variant_view")],
        W(zero.filter((F.size(based) > 0) & (F.size(told) > 0)), "a relative delta against zero"),
    )


def diff_view_hashes(a: DataFrame, nodes: DataFrame) -> DataFrame:
    """Views of both sides against their recorded hashes. The base is looked for among the capsules of the table, by the last part of its path."""
    every = objects(_of(nodes, "diff.json"))
    pairs = every.filter(F.col("up") == "pairs")
    sums = every.filter(F.col("key").isin("source_sha256", "instrument_sha256") & F.col("up").startswith("pairs/"))
    keys = F.when(F.col("key") == "source_sha256", F.array(F.lit("base_view"), F.lit("variant_view"))).otherwise(F.array(F.lit("base_frame"), F.lit("variant_frame")))
    each = sums.select("capsule", "file", "path", "up", "key", "keys", F.explode(keys).alias("side")).withColumn("said", _get(F.col("side"))["value"])
    base = every.filter(F.col("path") == "base").select("capsule", F.element_at(F.split(F.regexp_replace(F.coalesce(_get("path")["value"], F.lit("")), "/+$", ""), "/"), -1).alias("base"))
    capsules = a.select(F.col("capsule").alias("known")).distinct()
    away = base.join(capsules, F.col("base") == F.col("known"), "left_anti").withColumn("path", F.lit("diff.json"))
    views = a.filter(F.col("folder") == "views").select(F.col("capsule").alias("c"), F.col("name").alias("f"), F.sha2("content", 256).alias("h"))
    sound = each.filter((F.col("key") == "source_sha256") & is_sha256(F.col("said")))
    names = pairs.select("capsule", F.col("path").alias("up"), F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.when(_get(s)["kind"] == "string", _get(s)["value"]).alias("view")) for s in ("base_view", "variant_view")])).alias("n")).select("capsule", "up", "n.*")
    due = sound.join(names, ["capsule", "up", "side"]).filter(F.col("view").isNotNull() & ~F.col("view").contains("/")).join(base, "capsule", "left").withColumn("owner", F.when(F.col("side") == "base_view", F.col("base")).otherwise(F.col("capsule")))
    due = due.join(capsules, F.col("owner") == F.col("known"), "left_semi").join(views, (F.col("owner") == F.col("c")) & (F.col("view") == F.col("f")), "left")
    E = lambda rows, said: finding(rows, "diff_view_hashes", "E", said)  # noqa: E731, N806
    W = lambda rows, said: finding(rows, "diff_view_hashes", "W", said)  # noqa: E731, N806
    return _all(
        W(away, "the base is not at hand"),
        W(pairs.withColumn("lost", _missing(*[(F.coalesce(_get(k)["kind"] == "object", F.lit(False)), k) for k in ("source_sha256", "instrument_sha256")])).filter("lost <> ''"), F.concat(F.lit("no "), "lost")),
        W(each.filter(~is_sha256(F.col("said"))), "not a sha256"), E(due.filter(F.col("h").isNull()), "the view is not there"), E(due.filter(F.col("h") != F.lower("said")), "the view is not the one that was compared"),
    )


def publication_residue(a: DataFrame, nodes: DataFrame) -> DataFrame:
    leaf = nodes.filter((F.col("depth") > 0) & ~F.col("kind").isin("object", "array"))
    left = ((F.col("parent") == "") & F.lower("name").isin("status", "_pending")) | F.col("name").startswith("_")
    return finding(leaf.filter(left), "publication_residue", "W", "a key of work in progress", F.concat_ws("#", "file", "path"))


def punctuation(a: DataFrame, nodes: DataFrame) -> DataFrame:
    from tidemark.operators.text import forbidden_count

    rows = a.filter(F.col("extension").isin("json", "txt", "csv", "java", "md") & F.col("text").isNotNull()).withColumn("n", forbidden_count(F.col("text"))).filter(F.col("n") > 0)
    said = F.concat(F.col("n").cast("string"), F.lit(" dashes that are not hyphens"))
    return _all(finding(rows.filter(F.col("path") == "setup.txt"), "punctuation", "W", said), finding(rows.filter(F.col("path") != "setup.txt"), "punctuation", "E", said))


CHECKS: tuple[Check, ...] = (
    root_name, required_files, declared_files, not_empty, encoding, setup_notation, json_parses, environment, summary_blocks, plane_pairs, csv_header, png_geometry,
    png_metadata, view_field, signed_range, transient_layers, reference_block, dimensional_flags, extensions, no_instrument_dir, diff_manifest, diff_view_hashes, publication_residue, punctuation,
)


def validate(artifacts: DataFrame, checks: tuple[Check, ...] = CHECKS) -> DataFrame:
    """All findings of all checks. The files and the node table are written once, and all checks read these."""
    a = _decoded(stored(texts(artifacts).drop("text"), "artifacts"))
    docs = a.filter((F.col("extension") == "json") & F.col("text").isNotNull()).select("capsule", F.col("path").alias("file"), "text")
    nodes = stored(json_nodes(docs), "nodes")
    return _all(*[check(a, nodes) for check in checks])


def rollup(findings: DataFrame, capsules: DataFrame, strict: bool = False) -> DataFrame:
    """Worst severity per capsule: FAIL, WARN or PASS; under strict a warning fails."""
    rank = F.when(F.col("severity") == "E", 2).when(F.col("severity") == "W", 2 if strict else 1).otherwise(0)
    worst = findings.groupBy("capsule").agg(F.max(rank).alias("worst"), F.count_if(F.col("severity") == "E").alias("errors"), F.count_if(F.col("severity") == "W").alias("warnings"))
    out = capsules.select("capsule").distinct().join(worst, "capsule", "left")
    status = F.when(F.col("worst") == 2, "FAIL").when(F.col("worst") == 1, "WARN").otherwise("PASS")
    return out.select("capsule", status.alias("status"), F.coalesce("errors", F.lit(0)).alias("errors"), F.coalesce("warnings", F.lit(0)).alias("warnings"))
