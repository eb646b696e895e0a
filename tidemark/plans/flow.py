"""Whole flows put together from operators: history guard, flow summary, artifact validation, sweeps."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections import deque
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expr import close
from tidemark.operators import diff, features, ledger, rules, signals, windows
from tidemark.session import ship
from tidemark.sources import readers, sinks


def replay(history: DataFrame, size: int, run: list[str], signal: list[str], offenders: DataFrame | None = None, position: str = "i", value: str = "value") -> dict[str, DataFrame]:
    """Windows, gate, decision and published values of all runs in one plan. ``history``: run and signal columns, position, value."""
    key = [*run, *signal]
    stats = windows.schmitt_cycles(history, windows.window_stats(history, size, key, position, value), size, key, position, value)
    gate = windows.stationarity_gate(stats, key)
    decision = windows.stop_decision(stats, gate, run, signal, size, offenders)
    return {"windows": stats, "gate": gate, "decision": decision, "published": windows.pooled_publish(history, decision.drop("window"), size, run, signal, position, value)}


def guard(published: DataFrame, declared: DataFrame, key: list[str], columns: list[str], tolerance: float = 1e-9) -> DataFrame:
    """Rows where a declared statistic is not what the history gives: key, column, declared, recomputed; one side may be missing."""
    pairs = lambda df, name: df.select(*key, F.explode(F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("double"))])).alias("column", name))
    both = pairs(declared, "declared").join(pairs(published, "recomputed"), [*key, "column"], "full")
    return both.filter(~close("declared", "recomputed", tolerance))


def flow_summary(samples: DataFrame, key: list[str], reference: str, t0: float, t1: float, signal: str = "signal") -> DataFrame:
    """Per signal the time mean and rms over the whole periods of the reference signal within [t0, t1], with frequency, periods and amplitude of the reference.

    The window comes from one signal and is joined to all others: one row per key.
    """
    ship(samples.sparkSession)
    inside = signals.search_window(samples, [*key, signal], t0, t1)
    one = signals.about_mean(inside.filter(F.col(signal) == reference), [*key, signal]).drop("spans")
    crossings = signals.upward_crossings(one, [*key, signal])
    window = signals.period_window(crossings, [*key, signal]).join(signals.peak_to_peak(one, crossings, [*key, signal]).drop("cycles"), [*key, signal]).drop(signal)
    keys = key or ["_all"]
    widen = (lambda df: df) if key else (lambda df: df.withColumn("_all", F.lit(1)))
    spans = widen(window).select(*keys, F.lit("whole").alias("half"), F.col("t_start").alias("a"), F.col("t_end").alias("b"))
    stats = signals.trapezoid_stats(widen(samples), spans.join(widen(samples).select(*keys, signal).distinct(), keys), [*keys, signal], ["half"])
    out = stats.drop("half").join(widen(window), keys)
    return out if key else out.drop("_all")


def check_artifacts(spark: SparkSession, root: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Findings and one status row per artifact of a folder."""
    artifacts = readers.scan_artifacts(spark, root)
    findings = rules.validate(artifacts)
    return findings, rules.rollup(findings, artifacts, strict)


def feature_flow(cloud: DataFrame, stations: list[float], width: float, cut: float, beta: float, link: float, floor: float = 0.0) -> DataFrame:
    """Clusters per station and sense in one plan: z cut, stations, relative threshold, sign, links, summary, floor.

    ``cloud``: node, x, y, z, volume, q, wx (signed weight). The cut comes before the largest q of a station is taken.
    """
    binned = features.station_bin(features.cut(cloud, cut), stations, width)
    points = features.relative_threshold(binned, ["station"], "q", beta).filter(F.col("wx") != 0).withColumn("sense", F.signum("wx").cast("int"))
    rows = features.clustered(points, ["station", "sense"], "node", "y", "z", "volume", link)
    return features.cluster_summary(rows, ["station", "sense", "cluster"], F.col("wx"), F.col("volume"), "q", "node", ["y", "z"], width, floor)


def build_sweep(
    spark: SparkSession, points: dict[str, str], out: str, declared: list[str], strict: bool = True, base: str | None = None, contract: dict | None = None, at_once: int = 4
) -> list[Outcome]:
    """Every point from its source folder: copies of the declared files, the difference to the base, tokens, a check, an archive.

    All points are copied before the first difference is taken, and tokens are counted after it, so they include it. A
    point that fails does not stop the others. ``points``: name to source folder. ``base``: the point to which all
    others are compared, built here or by an earlier sweep; ``contract``: what else their diff.json says. A result has
    status, errors, tokens, archive and blockers: reasons why the point can't be published.
    """
    top = out.rstrip("/")
    copied = sweep(points, lambda name: sinks.whitelist_copy(points[name], f"{top}/{name}", declared), at_once=at_once)
    failed = {o.point for o in copied if o.error is not None}
    there = base is not None and base not in failed and Path(f"{top}/{base}/summary.json").is_file()

    def finish(name: str) -> dict:
        target, blockers = f"{top}/{name}", []
        if base is not None and name != base:
            if there:
                sinks.write_json(against(spark, f"{top}/{base}", target, contract or {}), f"{target}/diff.json")
            else:
                blockers.append(f"no difference: {base} is not built")
        files = lambda: readers.scan_artifacts(spark, out).filter(F.col("capsule") == name)
        tokens = settled_tokens(target, files)
        artifacts = files()
        status = rules.rollup(rules.validate(artifacts), artifacts, strict).first()
        if status["status"] == "FAIL":
            blockers.append("the check fails")
        sinks.write_zip(target, f"{target}.zip")
        return {"status": status["status"], "errors": status["errors"], "tokens": tokens, "archive": f"{target}.zip", "blockers": blockers}

    finished = {o.point: o for o in sweep([p for p in points if p not in failed], finish, spark, at_once)}
    outcomes = [finished.get(o.point, o) for o in copied]
    if there and base in finished and finished[base].error is not None:
        for o in outcomes:
            if o.error is None:
                o.result["blockers"].append(f"{base} failed after the difference")
    return outcomes


def against(spark: SparkSession, base: str, variant: str, contract: dict) -> dict:
    """What diff.json says: the contract, and the change of every number that both summaries hold, by its place."""
    texts = [(side, "summary.json", Path(f"{folder}/summary.json").read_text("utf-8")) for side, folder in (("base", base), ("variant", variant))]
    numbers = rules.json_nodes(ship(spark).createDataFrame(texts, "capsule string, file string, text string")).filter("kind = 'number'").select("capsule", "path", "number")
    side = lambda s: numbers.filter(F.col("capsule") == s).drop("capsule")
    deltas = diff.scalar_delta(side("base"), side("variant"), ["path"], "number").orderBy("path").collect()  # at most the numbers of one summary
    shown = {r["path"]: {"base": r["base"], "variant": r["variant"], "delta": r["delta"]} | ({} if r["relative"] is None else {"relative": r["relative"]}) for r in deltas}
    return contract | {"base": {"capsule": Path(base).name} | contract.get("base", {}), "scalar_deltas": shown}


def settled_tokens(target: str, files: Callable[[], DataFrame]) -> int:
    """Tokens of all files of an artifact. With a manifest they are written into it and counted again until that changes nothing."""
    kind = ledger.kind_of(F.col("path"))
    characters = F.when(kind == "image", F.lit(0)).otherwise(F.length(F.decode("content", "UTF-8")))
    manifest = Path(f"{target}/manifest.json")

    def measure() -> dict:
        rows = files().groupBy(kind.alias("kind")).agg(F.sum(ledger.tokens_by_kind(kind, characters)).alias("tokens")).orderBy("kind").collect()
        return {"total": sum(r["tokens"] for r in rows), "by_kind": {r["kind"]: r["tokens"] for r in rows}}

    if not manifest.is_file():
        return measure()["total"]
    write = lambda now: sinks.write_json(json.loads(manifest.read_text("utf-8")) | {"tokens": now}, str(manifest))
    return sinks.settle(measure, write)["total"]


@dataclass
class Outcome:
    point: str
    result: object = None
    error: str | None = None


def sweep(points: Iterable[str], step: Callable[[str], object], spark: SparkSession | None = None, at_once: int = 4, timeout: float | None = None) -> list[Outcome]:
    """Run ``at_once`` points at the same time; outcomes come in the order of the points. A failure is recorded and the others go on.

    With ``spark``, the jobs of a point run in a scheduler pool and under a tag of their own: under the fair scheduler
    (``spark.scheduler.mode``) no point waits for all stages of another, and a point that takes longer than ``timeout``
    seconds has its jobs cancelled and its place given to the next. What such a point does outside of Spark can't be
    stopped: it goes on in a daemon thread, but jobs that it starts while the sweep still runs are cancelled too.
    """
    names = list(points)
    outcomes: list[Outcome | None] = [None] * len(names)
    late: set[str] = set()
    waiting = deque(enumerate(names))
    running: dict[int, tuple[threading.Thread, float, str]] = {}
    mark = uuid.uuid4().hex[:12]

    def run(k: int, tag: str) -> None:
        if spark is not None:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", tag)
            spark.sparkContext.addJobTag(tag)
            spark.sparkContext.setInterruptOnCancel(True)
        try:
            done = Outcome(names[k], step(names[k]))
        except Exception as e:  # the point fails, not the sweep
            done = Outcome(names[k], error=f"{type(e).__name__}: {e}")
        if tag not in late:
            outcomes[k] = done

    def start() -> None:
        k, _ = waiting.popleft()
        tag = f"sweep-{mark}-{k}"
        target = inheritable_thread_target(spark)(run) if spark is not None else run
        thread = threading.Thread(target=target, args=(k, tag), daemon=True)
        running[k] = (thread, time.monotonic(), tag)
        thread.start()

    given_up: list[tuple[threading.Thread, str]] = []
    while waiting or running:
        while waiting and len(running) < at_once:
            start()
        next(iter(running.values()))[0].join(0.05)
        for k, (thread, began, tag) in list(running.items()):
            if not thread.is_alive():
                del running[k]
            elif timeout is not None and time.monotonic() - began > timeout:
                late.add(tag)
                outcomes[k] = Outcome(names[k], error=f"TimeoutError: not done after {timeout:g} s")
                given_up.append((thread, tag))
                del running[k]
        given_up = [(thread, tag) for thread, tag in given_up if thread.is_alive()]
        if spark is not None:
            for _, tag in given_up:
                spark.sparkContext.cancelJobsWithTag(tag)
    return outcomes
