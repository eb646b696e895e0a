"""Command line: ``python -m tidemark <command> ...``. Results are printed; nothing is written without --write."""

from __future__ import annotations

import argparse
import json
import re
import sys
from pathlib import Path

from tidemark.session import local_session, shared_base


def _print(df, kind: str = "text") -> None:
    """All rows; none is cut off."""
    from tidemark.sources.sinks import REPORTS

    sys.stdout.write(REPORTS[kind](df))


def _validate(a: argparse.Namespace) -> int:
    from tidemark.plans.flow import check_artifacts

    findings, status = check_artifacts(_session(), a.root, a.strict)
    _print(findings.orderBy("capsule", "check_id", "path"), a.format)
    _print(status.orderBy("capsule"), a.format)
    return int(not status.filter("status = 'FAIL'").isEmpty())


def _session():
    spark = local_session()
    spark.sparkContext.setCheckpointDir(shared_base(spark))
    return spark


def _ledger(a: argparse.Namespace) -> int:
    from pyspark.sql import functions as F

    from tidemark.operators import ledger
    from tidemark.sources.readers import scan_artifacts

    files = scan_artifacts(local_session(), a.root)
    kind = ledger.kind_of(F.col("path"))
    characters = F.when(kind == "image", F.lit(0)).otherwise(F.length(F.decode("content", "UTF-8")))
    rows = files.select("capsule", ledger.layer_of(F.col("path")).alias("layer"), characters.alias("characters"), ledger.tokens_by_kind(kind, characters).alias("tokens"), (kind == "image").alias("estimated"))
    _print(ledger.ledger(rows, ["capsule"], a.budget).orderBy("capsule", F.col("layer").asc_nulls_last()), a.format)
    return 0


def _frozen(a: argparse.Namespace) -> int:
    from pyspark.sql import functions as F

    from tidemark.operators.diff import manifest_drift
    from tidemark.sources.readers import read_hash_list, scan_artifacts

    spark = local_session()
    here = scan_artifacts(spark, a.root).select(F.concat_ws("/", "capsule", "path").alias("path"), F.sha2("content", 256).alias("sha256"))
    drift = manifest_drift(read_hash_list(spark, a.manifest), here).filter("drift <> 'same'")
    _print(drift.orderBy("path"), a.format)
    return int(not drift.isEmpty())


def _setup(a: argparse.Namespace) -> int:
    from tidemark.operators import text

    step = text.encode if a.way == "encode" else text.decode
    out = step(Path(a.file).read_bytes().decode("utf-8"))
    if a.write:
        Path(a.write).write_bytes(out.encode("utf-8"))
    else:
        sys.stdout.write(out)
    return 0


def _migrate(a: argparse.Namespace) -> int:
    from tidemark.operators.migrate import migrate

    edits = [tuple(e) for e in json.loads(Path(a.edits).read_text())]
    new, report = migrate(Path(a.file).read_text(encoding="utf-8"), edits)
    for kind in ("changed", "already", "problems"):
        for line in getattr(report, kind):
            print(f"{kind}: {line}")
    if new and a.write:
        Path(a.file).write_text(new, encoding="utf-8")
    return int(bool(report.problems))


def _summary(a: argparse.Namespace) -> int:
    from tidemark.plans.flow import flow_summary
    from tidemark.sources.readers import read_signals

    spark = local_session()
    _print(flow_summary(read_signals(spark, a.folder), [], a.reference, a.start, a.end), a.format)
    return 0


def _guard(a: argparse.Namespace) -> int:
    from tidemark.operators.guard import guard
    from tidemark.sources.readers import read_sweep, scan_artifacts

    spark = _session()
    config = read_sweep(Path(a.sweep).read_text(encoding="utf-8"))
    points = [(p, d.get("regime_expected"), json.dumps(d["uncertainty"]) if "uncertainty" in d else None) for p in config["points"] for d in [config.get("declared", {}).get(str(p), {})]]
    found = guard(scan_artifacts(spark, a.root), spark.createDataFrame(points, "re long, regime_expected string, uncertainty string"), config.get("regime_ref")).checkpoint()
    _print(found.orderBy("capsule", "rule"), a.format)
    return int(not found.filter("NOT ok").isEmpty())


def _mirror(a: argparse.Namespace) -> int:
    from pyspark.sql import functions as F

    from tidemark.operators import neighbours
    from tidemark.sources.readers import read_csv_strict

    good, bad = read_csv_strict(_session(), a.table, {"x": "X", "y": "Y", "z": "Z", "volume": "Volume"}, positive=("volume",))
    if not bad.isEmpty():
        _print(bad, a.format)
        return 1
    cloud = good.withColumn("cell", F.monotonically_increasing_id()).withColumn("size", F.cbrt("volume")).checkpoint()
    pairs = neighbours.mirror_pairs(cloud, "cell", a.axis, ["x", "y", "z"], "size").checkpoint()
    _print(neighbours.outcome_counts(pairs, cloud.count()), a.format)
    _print(neighbours.nearest_rank(pairs.filter("outcome = 'paired'").withColumn("all", F.lit("all")), ["all"], "delta"), a.format)
    return 0


def _sample(a: argparse.Namespace) -> int:
    from pyspark.sql import functions as F

    from tidemark.operators import sample
    from tidemark.sources.readers import read_csv_strict

    good, _ = read_csv_strict(_session(), a.table, {"x": "X", "y": "Y", "z": "Z", "volume": "Volume", "field": a.field})
    weight = F.col("volume") * F.pow(F.greatest("field", F.lit(0.0)), F.lit(a.alpha)) if a.alpha else F.col("volume")
    total = sample.totals(good, weight, F.col("volume")).first()
    kept = sample.importance_sample(good, a.keep, weight, ["x", "y", "z"], a.seed)
    _print(sample.with_volume_weight(kept, total["total_weight"], total["total_volume"]).orderBy("x", "y", "z"), a.format)
    return 0


def _signals(a: argparse.Namespace) -> int:
    from tidemark.operators import signals
    from tidemark.sources.readers import read_signals

    s = signals.about_mean(signals.search_window(read_signals(_session(), a.folder, strict=True), ["signal"], a.start, a.end), ["signal"])
    crossings = signals.upward_crossings(s, ["signal"])
    _print(signals.period_window(crossings, ["signal"]).orderBy("signal"), a.format)
    _print(signals.halves_test(s, crossings, ["signal"]).orderBy("signal"), a.format)
    return 0


def _diff(a: argparse.Namespace) -> int:
    from pyspark.sql import functions as F

    from tidemark.operators import diff
    from tidemark.sources.images import frames
    from tidemark.sources.readers import scan_artifacts

    spark = _session()
    base, variant = (frames(scan_artifacts(spark, r).filter(F.col("path").endswith(".png")).select(F.concat_ws("/", "capsule", "path").alias("image"), "content"), a.crop) for r in (a.base, a.variant))
    _print(diff.pixel_change(base, variant, "image", "pixels", a.threshold).orderBy("image"), a.format)
    return 0


def _extract(a: argparse.Namespace) -> int:
    from tidemark.sources.sinks import whitelist_copy

    names = whitelist_copy(a.source, a.target, a.pattern) if a.write else sorted(f.relative_to(a.source).as_posix() for f in Path(a.source).rglob("*") if f.is_file() and any(re.fullmatch(p, f.relative_to(a.source).as_posix()) for p in a.pattern))
    sys.stdout.write("".join(f"{n}\n" for n in names))
    return 0


def _features(a: argparse.Namespace) -> int:
    from pyspark.sql import functions as F

    from tidemark.plans.flow import feature_flow
    from tidemark.sources.readers import read_csv_strict

    good, _ = read_csv_strict(_session(), a.table, {"x": "X", "y": "Y", "z": "Z", "volume": "Volume", "q": a.q, "wx": a.vorticity})
    found = feature_flow(good.withColumn("node", F.monotonically_increasing_id()).checkpoint(), a.stations, a.width, a.cut, a.beta, a.link)
    _print(found.orderBy("station", "sense", "cluster"), a.format)
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    sub = p.add_subparsers(required=True)

    def command(name: str, run, *arguments: tuple) -> None:
        c = sub.add_parser(name)
        c.set_defaults(run=run)
        for names, options in arguments:
            c.add_argument(*names, **options)
        c.add_argument("--format", choices=["text", "markdown", "json"], default="text")

    number = lambda name, value: ((name,), {"type": type(value), "default": value})
    command("sample", _sample, (("table",), {}), (("field",), {}), number("--alpha", 1.0), number("--keep", 800), number("--seed", 42))
    command("features", _features, (("table",), {}), (("--stations",), {"type": float, "nargs": "+", "required": True}), number("--width", 0.05), number("--cut", 0.0), number("--beta", 0.05), number("--link", 2.5), number("--q", "Q"), number("--vorticity", "Vorticity: X"))
    command("mirror", _mirror, (("table",), {}), (("--axis",), {"choices": ["x", "y", "z"], "default": "y"}))
    command("signals", _signals, (("folder",), {}), number("--start", 100.0), number("--end", 300.0))
    command("guard", _guard, (("root",), {}), (("sweep",), {}))
    command("diff", _diff, (("base",), {}), (("variant",), {}), number("--threshold", 3), number("--crop", 0))
    command("extract", _extract, (("source",), {}), (("target",), {}), (("pattern",), {"nargs": "+"}), (("--write",), {"action": "store_true"}))
    command("validate", _validate, (("root",), {}), (("--strict",), {"action": "store_true"}))
    command("ledger", _ledger, (("root",), {}), (("--budget",), {"type": int, "default": 60_000}))
    command("frozen", _frozen, (("manifest",), {}), (("root",), {}))
    command("setup", _setup, (("way",), {"choices": ["encode", "decode"]}), (("file",), {}), (("--write",), {}))
    command("migrate", _migrate, (("file",), {}), (("edits",), {}), (("--write",), {"action": "store_true"}))
    command("summary", _summary, (("folder",), {}), (("--reference",), {"default": "cl"}), (("--start",), {"type": float, "default": 100.0}), (("--end",), {"type": float, "default": 300.0}))
    a = p.parse_args(argv)
    return a.run(a)


if __name__ == "__main__":
    sys.exit(main())
