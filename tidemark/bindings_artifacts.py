"""Whole artifacts made of table rows, checked by the validator and the guard, with the findings that SQL expects of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.bindings import _events, query, table
from tidemark.operators import guard, rules

# --- the validator over documents: every text becomes the files of an artifact, with faults by id and language ---------


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its text as setup.txt (long ones only), as a summary that is not JSON, as notes, and an empty file."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    own = F.concat(F.when(F.col("lang") == "de", F.lit("export_")).otherwise(F.lit("capsule_")), F.col("doc_id").cast("string"))
    k = F.col("doc_id")
    dash = F.concat("text", F.when(k % 7 == 3, "—").otherwise(""))
    plain = lambda c: F.encode(c, "UTF-8")
    file = lambda path, content, there: F.when(there, F.struct(F.lit(path).alias("path"), content.alias("content")))
    broken = F.concat(F.when(k % 6 == 0, F.lit(b"\xff")).otherwise(F.lit(b"")), plain(dash))
    files = F.array(
        file("setup.txt", plain(F.concat(F.when(k % 5 == 2, "@k=0..3 ").otherwise(""), dash)), F.length("text") >= 200), file("summary.json", plain(F.concat(F.lit("{"), F.col("text"))), k % 4 == 0),
        file("notes.md", broken, k % 3 == 0), file("odd/empty.txt", F.lit(b""), k % 5 == 0), file("views/a/deep.txt", plain(F.lit("x")), k % 11 == 0), file("views/Bad.txt", plain(F.lit("x")), k % 13 == 0),
        file("disclosure.json", plain(F.concat(F.lit('{"_draft": 1, "kept": '), k.cast("string"), F.lit("}"))), k % 2 == 0),
        file("manifest.json", plain(F.lit("{}")), k % 2 == 1),
    )
    rows = d.select(own.alias("capsule"), F.explode(F.array_compact(files)).alias("f")).select("capsule", "f.*")
    return rows.withColumn("length", F.octet_length("content").cast("bigint"))


_FOUND = """WITH d AS (SELECT doc_id AS k, coalesce(text, '') AS text, CASE WHEN lang = 'de' THEN 'export_' ELSE 'capsule_' END || doc_id AS capsule FROM documents),
f AS (
  SELECT capsule, 'root' AS check_id, 'E' AS severity, capsule AS path FROM d WHERE capsule LIKE 'export_%'
  UNION ALL SELECT capsule, 'required_files', 'E', 'setup.txt' FROM d WHERE length(text) < 200
  UNION ALL SELECT capsule, 'required_files', 'E', 'summary.json' FROM d WHERE k % 4 <> 0
  UNION ALL SELECT capsule, 'json_parses', 'E', 'summary.json' FROM d WHERE k % 4 = 0
  UNION ALL SELECT capsule, 'declared_files', 'E', 'notes.md' FROM d WHERE k % 3 = 0
  UNION ALL SELECT capsule, 'declared_files', 'E', 'odd/empty.txt' FROM d WHERE k % 5 = 0
  UNION ALL SELECT capsule, 'declared_files', 'E', 'views/a/deep.txt' FROM d WHERE k % 11 = 0
  UNION ALL SELECT capsule, 'declared_files', 'E', 'views/Bad.txt' FROM d WHERE k % 13 = 0
  UNION ALL SELECT capsule, 'not_empty', 'E', 'odd/empty.txt' FROM d WHERE k % 5 = 0
  UNION ALL SELECT capsule, 'not_empty', 'E', 'notes.md' FROM d WHERE k % 3 = 0 AND k % 6 <> 0 AND k % 7 <> 3 AND text = ''
  UNION ALL SELECT capsule, 'encoding', 'E', 'notes.md' FROM d WHERE k % 6 = 0
  UNION ALL SELECT capsule, 'setup_notation', 'W', 'setup.txt' FROM d WHERE k % 5 = 2 AND length(text) >= 200
  UNION ALL SELECT capsule, 'punctuation', 'W', 'setup.txt' FROM d WHERE k % 7 = 3 AND length(text) >= 200
  UNION ALL SELECT capsule, 'punctuation', 'E', 'notes.md' FROM d WHERE k % 7 = 3 AND k % 3 = 0 AND k % 6 <> 0
  UNION ALL SELECT capsule, 'publication_residue', 'W', 'disclosure.json#_draft' FROM d WHERE k % 2 = 0
)"""


@query(f"{_FOUND} SELECT capsule, check_id, severity, path FROM f")
def validate_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.validate(_files(spark, sf_dir)).select("capsule", "check_id", "severity", "path")


@query(f"""{_FOUND} SELECT d.capsule, CASE WHEN count(*) FILTER (WHERE severity = 'E') > 0 THEN 'FAIL' WHEN count(severity) > 0 THEN 'WARN' ELSE 'PASS' END AS status,
count(*) FILTER (WHERE severity = 'E') AS errors, count(*) FILTER (WHERE severity = 'W') AS warnings FROM d LEFT JOIN (FROM f WHERE check_id <> 'required_files') f USING (capsule) GROUP BY d.capsule""")
def validate_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The worst of every check but the one for missing files, which nearly all of these artifacts fail."""
    files = _files(spark, sf_dir)
    return rules.rollup(rules.validate(files, tuple(c for c in rules.CHECKS if c is not rules.required_files)), files)


# --- the guard over runs made of events: each run keeps the contract but for the rule that its number breaks -------------

ROWS = 150  # of a run: too few for a window behind the transient, so each run ends as diverged, with its last row published


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """capsule, broken (the rule to break: 1 to 14, none for others), and the rows of its history in order."""
    e = _events(spark, sf_dir).select("event_type", "i", F.coalesce("value", F.lit(0.0)).alias("v"))
    e = e.withColumn("run", F.floor(F.col("i") / ROWS))
    rows = e.groupBy("event_type", "run").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("rows")).filter(F.size("rows") == ROWS)
    return rows.select(F.concat_ws("_", F.lit("capsule"), "event_type", F.col("run").cast("string")).alias("capsule"), (F.col("run") % 16).alias("broken"), F.transform("rows", lambda r: r["v"]).alias("values"))


def _series(v: Column, name: str, last: Column) -> Column:
    """A column of the history from the value of an event; the mass imbalance ends the run with its last row."""
    if name == "mass_imbalance":
        return F.when(last, 0.5).otherwise(v * 1e-7)
    return v / 500 + 0.1 * guard.HEADER.index(name)


def _object(*fields: tuple[str, Column]) -> Column:
    """JSON text of an object whose values are JSON texts; fields that are null are left out."""
    parts = F.array(*[F.concat(F.lit(f'"{k}": '), v) for k, v in fields])
    return F.concat(F.lit("{"), F.array_join(F.array_compact(parts), ", "), F.lit("}"))


def _summary(broken: Column, last: Column) -> Column:
    """The summary of a run whose last event is ``last``, with one rule broken."""
    n = lambda x: (F.lit(float(x)) if isinstance(x, (int, float)) else x).cast("double").cast("string")
    s = lambda x: F.lit(f'"{x}"')
    at = lambda c: _series(last, c, F.lit(True))
    off = lambda rule, size=1.0: F.when(broken == rule, size).otherwise(0.0)
    only = lambda rule, v: F.when(broken == rule, v)

    def told(c: str, name: str | None = None, sd: bool = True, by: float = 1.0, wrong: Column | None = None) -> list[tuple[str, Column]]:
        name, value = name or c, at(c) / by
        out = [(name, n(value if wrong is None else value + wrong)), (f"{name}_window_iterations", n(1)), (f"{name}_n_windows", n(0)), (f"{name}_statistic", s("instantaneous"))]
        return out + ([(f"{name}_sd", n(0))] if sd else [])

    scale = 1.2 * 3.0 * 0.5 * 0.5
    g = guard.CONSTANTS
    constants = [(k, s(v) if isinstance(v, str) else n(F.lit(float(v)) + (off(4) if k == "k_gate" else 0.0))) for k, v in g.items()]
    conv = [
        *constants, ("status", s("diverged")), ("iterations", n(10 * ROWS)), ("windows_closed", n(off(6))), ("quantities", F.lit("{}")), ("time_basis", s("iterations")), ("band_low", only(5, F.lit("1"))), ("lift_kg", only(14, F.lit("1"))),
        ("regime_expected", F.lit('{"value": "unsteady", "source": "declared", "ref": "book"}')), ("solver_regime_mismatch", F.lit("false")),
        ("stop_reason", F.when(broken == 8, s("it stopped")).otherwise(s(f"NaN / mass imbalance 0.5 at iteration {10 * ROWS}."))), ("uncertainty", F.concat(F.lit('{"cd_relative": '), n(F.lit(0.01) + off(9)), F.lit("}"))),
    ]
    probe = _object(("value", n(at(guard.PROBE))), ("sd", n(0)), ("window_iterations", n(1)), ("n_windows", n(0)), ("statistic", s("instantaneous")), ("position_D", F.lit("[2.0, 0.0, 0.0]")))
    plane = lambda p: _object(*[(f, F.concat(F.lit("["), n(at(f"LLM_{f}_min_{p}")), F.lit(", "), n(at(f"LLM_{f}_max_{p}")), F.lit("]"))) for f in guard.FIELDS])
    return _object(
        ("sweep", F.lit('{"value": 300}')), ("reference", F.lit('{"density_kg_per_m3": 1.2, "velocity_m_per_s": 3.0, "side_m": 0.5}')), ("convergence", _object(*conv)),
        ("forces", _object(*told("cd", wrong=off(10)), *told("cl"), *told("cy"), *told("cd_pressure"), *told("cd_friction"), ("extra", only(13, F.lit("1"))))),
        ("pressure", _object(*told("cp_base"), *told("cp_min", sd=False, wrong=off(12)), *told("cp_stagnation", sd=False))),
        ("wake", _object(*told("x_reattach", "x_reattach_D", wrong=off(11)), *told("recirculation_length_D"), ("note", s(guard.WAKE_NOTE)))),
        ("mass", _object(*told("mdot_in", "mdot_in_over_rhoUD2", by=scale), *told("mdot_out", "mdot_out_over_rhoUD2", by=scale), *told("mass_imbalance"))),
        ("probes", _object((guard.PROBE, probe))), ("plane_extremes", _object(*[(p, plane(p)) for p in guard.PLANES], ("statistic", s("instantaneous")), ("window_iterations", n(1)), ("n_windows", n(0)))),
    )


@query("""WITH r AS (SELECT event_type, i // 150 AS run FROM (SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS i FROM events) GROUP BY ALL HAVING count(*) = 150),
g AS (SELECT CAST(unnest(range(1, 15)) AS INTEGER) AS g)
SELECT 'capsule_' || event_type || '_' || run AS capsule, 'G' || lpad(CAST(g AS VARCHAR), 2, '0') AS rule, g <> run % 16 OR g = 7 AS ok FROM r, g WHERE NOT (run % 16 = 2 AND g > 3)""")
def guard_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule 7 compares gates, of which such short runs have none; a run with another header is not replayed."""
    r = _runs(spark, sf_dir)
    head = ",".join(guard.HEADER)
    cells = lambda v, i: F.concat_ws(",", (10 * (i + 1) + F.when((F.col("broken") == 3) & (i == 2), 1).otherwise(0)).cast("string"), *[_series(v, c, i == ROWS - 1).cast("string") for c in guard.HEADER[1:]])
    lines = F.concat(F.array(F.when(F.col("broken") == 2, head.replace("cp_base", "cp_back")).otherwise(head)), F.transform("values", cells))
    name = F.when(F.col("broken") == 1, "monitor_history_re0301.csv").otherwise("monitor_history_re0300.csv")
    last = F.element_at("values", -1)
    two = F.array(F.struct(name.alias("path"), F.array_join(lines, "\n").alias("body")), F.struct(F.lit("summary.json").alias("path"), _summary(F.col("broken"), last).alias("body")))
    files = r.select("capsule", F.explode(two).alias("f")).select("capsule", "f.path", F.encode("f.body", "UTF-8").alias("content"))
    files = files.withColumn("length", F.octet_length("content").cast("bigint")).checkpoint()
    declared = spark.range(1).select(F.lit(300).cast("bigint").alias("re"), F.lit("unsteady").alias("regime_expected"), F.lit('{"cd_relative": 0.01}').alias("uncertainty"))
    return guard.guard(files, declared, "book").select("capsule", "rule", "ok")
