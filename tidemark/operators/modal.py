"""Discretisation error from three meshes, and proper orthogonal decomposition by snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shared_base

#: Safety factor with three meshes, and where the order is above its band.
SAFETY, SAFETY_ABOVE = 1.25, 3.0


def discretization(df: DataFrame, key: list[str], fine: str, medium: str, coarse: str, ratio: float, expected: float = 2.0, band: float = 0.5, resolution: float = 0.0) -> DataFrame:
    """Per key: behaviour, observed order p, extrapolated value, gci_fine, status, from values on three meshes of constant ratio."""
    d1, d2 = F.col(medium) - F.col(fine), F.col(coarse) - F.col(medium)
    rows = df.withColumn("_q", F.try_divide(d2, d1))
    behaviour = F.when(d1 * d2 < 0, "oscillatory").otherwise("monotone")
    p = F.when((d1 != 0) & (d2 != 0), F.abs(F.ln(F.abs("_q"))) / F.lit(float(np.log(ratio))) * F.signum(F.abs("_q") - 1))
    rows = rows.withColumn("behaviour", behaviour).withColumn("p", p)
    shrinks = F.abs(d1) < F.abs(d2)
    tiny = F.greatest(F.abs(d1), F.abs(d2)) <= F.lit(resolution)
    status = (
        F.when(tiny, "nominal").when(F.col("p").isNull() | ~shrinks, "not_asymptotic").when(F.col("behaviour") == "oscillatory", "converged")
        .when(F.col("p") > expected + band, "above_order").when(F.col("p") < expected - band, "reduced_order").otherwise("converged")
    )
    rows = rows.withColumn("status", status)
    growth = lambda order: F.pow(F.lit(float(ratio)), order) - 1
    exact = F.col(fine) - d1 / growth(F.col("p"))
    monotone = F.col("behaviour") == "monotone"
    extrapolated = F.when(monotone & F.col("status").isin("converged", "reduced_order"), exact)
    span = F.greatest(fine, medium, coarse) - F.least(fine, medium, coarse)
    relative = F.abs(F.try_divide(d1, F.col(fine)))
    gci = F.when(F.col("status").isin("not_asymptotic", "nominal"), None).when(~monotone, F.abs(F.try_divide(span / 2, F.col(fine)))).when(F.col("status") == "above_order", F.lit(SAFETY_ABOVE) * relative / growth(F.lit(float(expected)))).otherwise(F.lit(SAFETY) * relative / growth(F.col("p")))
    return rows.select(*key, "behaviour", "p", extrapolated.alias("extrapolated"), gci.alias("gci_fine"), "status")


def _inner_products(steps: int, values: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((steps, steps))
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):  # so many nodes at once are a matrix of at most 256 x values x steps
                part = batch.slice(lo, 256)
                n = pc.list_value_length(part.column("at")).to_numpy()
                x = np.zeros((part.num_rows, values, steps))
                x[np.repeat(np.arange(len(n)), n), :, part.column("at").flatten().to_numpy()] = part.column("x").flatten().flatten().to_numpy().reshape(-1, values)
                flat = x.reshape(-1, steps)
                total += flat.T @ flat
        yield pa.record_batch([pa.array(np.arange(steps, dtype=np.int32)), pa.array([row.tobytes() for row in total], pa.binary())], ["i", "c"])

    return run


def _added(rows: pa.Table) -> pa.Table:
    """The sum of one row of all tasks' matrices."""
    total = sum(np.frombuffer(c) for c in rows.column("c").to_pylist())
    return pa.table({"i": rows.column("i").slice(0, 1), "c": pa.array([total.tobytes()], pa.binary())})


#: Nodes and steps on a side of a tile, on average; columns of the first search for modes beyond ``most_steps``, and passes over the tiles.
TILE, SEARCH, PASSES = 256, 16, 4


def _dealt(rows: DataFrame, name: str, prefix: str) -> tuple[DataFrame, int]:
    """Every distinct value of a column with its block and place there, and how many values there are."""
    values = rows.select(name).distinct()
    many = values.count()
    block = F.pmod(F.xxhash64(name), F.lit(-(-many // TILE) or 1))
    place = F.row_number().over(Window.partitionBy(f"{prefix}_block").orderBy(name)) - 1
    return values.withColumn(f"{prefix}_block", block).withColumn(f"{prefix}_at", place), many


def _product(tiles: DataFrame, other: DataFrame, by: str, to: str, transposed: bool) -> DataFrame:
    """(to, m): the tiles' matrix, or its transpose, times a matrix whose blocks are rows (by, m) of ``other``."""

    def times(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for high, wide, x, m in zip(*(batch.column(c).to_pylist() for c in ("high", "wide", "x", "m")), strict=True):
                x = np.frombuffer(x).reshape(high, wide)
                x = x.T if transposed else x
                out.append((x @ np.frombuffer(m).reshape(x.shape[1], -1)).tobytes())
            yield pa.record_batch([batch.column(to), pa.array(out, pa.binary())], [to, "m"])

    def added(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(m) for m in rows.column("m").to_pylist())
        return pa.table({to: rows.column(to).slice(0, 1), "m": pa.array([total.tobytes()], pa.binary())})

    schema = f"{to} bigint, m binary"
    parts = tiles.join(other, by).select(to, "high", "wide", "x", "m").mapInArrow(times, schema)
    # partial sums by a few salts first, so that a block of steps that all nodes share is no single task
    salted = parts.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(64)))
    some = salted.groupBy(to, "salt").applyInArrow(added, schema)
    return some.groupBy(to).applyInArrow(added, schema)


def _gram(blocks: DataFrame, wide: int) -> np.ndarray:
    """The small matrix of inner products of the columns of a matrix in blocks."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((wide, wide))
        for batch in batches:
            for m in batch.column("m").to_pylist():
                m = np.frombuffer(m).reshape(-1, wide)
                total += m.T @ m
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["m"])

    # the tasks' sums are small and as many as tasks: one row each
    return sum((np.frombuffer(r["m"]) for r in blocks.select("m").mapInArrow(own, "m binary").toLocalIterator()), np.zeros(wide * wide)).reshape(wide, wide)


def _mixed(blocks: DataFrame, key: str, by: np.ndarray) -> DataFrame:
    """A matrix in blocks times a small matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(np.frombuffer(m).reshape(-1, len(by)) @ by).tobytes() for m in batch.column("m").to_pylist()]
            yield pa.record_batch([batch.column(key), pa.array(out, pa.binary())], [key, "m"])

    return blocks.select(key, "m").mapInArrow(run, f"{key} bigint, m binary")


def _unfolded(blocks: DataFrame, key: str, names: DataFrame, at: str, columns: list[str], wide: int) -> DataFrame:
    """Blocks as rows: every named place with its ``columns``, each an array of ``wide`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, m in zip(batch.column(key).to_pylist(), batch.column("m").to_pylist(), strict=True):
                m = np.frombuffer(m).reshape(-1, len(columns), wide)
                arrays = [pa.FixedSizeListArray.from_arrays(pa.array(m[:, i].ravel()), wide).cast(pa.list_(pa.float64())) for i in range(len(columns))]
                yield pa.record_batch([pa.array([k] * len(m), pa.int64()), pa.array(np.arange(len(m), dtype=np.int32)), *arrays], [key, at, *columns])

    schema = f"{key} bigint, {at} int, " + ", ".join(f"`{c}` array<double>" for c in columns)
    return blocks.select(key, "m").mapInArrow(run, schema).join(names, [key, at])


def pod_of_many(snapshots: DataFrame, node: str, step: str, values: list[str], share: float = 0.999, search: int = SEARCH, passes: int = PASSES) -> tuple[list[float], DataFrame, DataFrame]:
    """As :func:`pod` for any number of steps, by a randomised range finder with subspace iteration.

    The fluctuations are cut into tiles of nodes and steps, written once. A random matrix of ``search`` columns is
    multiplied by them back and forth; what is left spans the strongest modes. Only matrices of ``search`` squared come
    to the driver. The energy of everything is summed exactly, so it is known whether the modes found hold the wanted share;
    while they don't, ``search`` is doubled, at most to the number of steps, where the result is complete.
    """
    spark = snapshots.sparkSession
    mean = snapshots.groupBy(node).agg(*[F.avg(v).alias(f"_m{v}") for v in values])
    moving = snapshots.join(mean, node).select(node, step, *[(F.col(v) - F.col(f"_m{v}")).cast("double").alias(v) for v in values])
    place_n, nodes = _dealt(snapshots, node, "n")
    place_s, steps = _dealt(snapshots, step, "s")
    base = f"{shared_base(spark).rstrip('/')}/tidemark/modes-{uuid.uuid4().hex}"
    place_n.write.parquet(f"{base}/nodes")
    place_s.write.parquet(f"{base}/steps")
    place_n, place_s = spark.read.parquet(f"{base}/nodes"), spark.read.parquet(f"{base}/steps")
    size_n = place_n.groupBy("n_block").agg((F.count(F.lit(1)) * len(values)).cast("int").alias("high"))
    size_s = place_s.groupBy("s_block").agg(F.count(F.lit(1)).cast("int").alias("wide"))

    def tile(rows: pa.Table) -> pa.Table:
        high, wide = rows.column("high")[0].as_py(), rows.column("wide")[0].as_py()
        x = np.zeros((high // len(values), len(values), wide))
        x[rows.column("n_at").to_numpy(), :, rows.column("s_at").to_numpy()] = np.column_stack([rows.column(v).to_numpy() for v in values])
        head = {c: rows.column(c).slice(0, 1) for c in ("n_block", "s_block", "high", "wide")}
        return pa.table({**head, "x": pa.array([x.tobytes()], pa.binary()), "e": pa.array([float((x * x).sum())])})

    placed = moving.join(place_n, node).join(place_s, step).join(size_n, "n_block").join(size_s, "s_block")
    placed = placed.select("n_block", "n_at", "s_block", "s_at", "high", "wide", *values)
    placed.groupBy("n_block", "s_block").applyInArrow(tile, "n_block bigint, s_block bigint, high int, wide int, x binary, e double").write.parquet(f"{base}/tiles")
    tiles = spark.read.parquet(f"{base}/tiles")
    everything = tiles.agg(F.sum("e")).first()[0] or 0.0

    def kept_at(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    while True:
        search = max(1, min(search, steps))

        def random_block(batches: Iterator[pa.RecordBatch], columns: int = search) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = [np.random.default_rng([k, columns]).normal(size=(n, columns)).tobytes() for k, n in zip(batch.column("s_block").to_pylist(), batch.column("wide").to_pylist(), strict=True)]
                yield pa.record_batch([batch.column("s_block"), pa.array(out, pa.binary())], ["s_block", "m"])

        q = kept_at(f"q{search}_0", size_s.mapInArrow(random_block, "s_block bigint, m binary"))
        for k in range(passes + 1):
            q = _orthonormal(q, "s_block", search)
            y = kept_at(f"y{search}_{k}", _product(tiles, q, "s_block", "n_block", False))
            if k < passes:
                q = kept_at(f"q{search}_{k + 1}", _product(tiles, y, "n_block", "s_block", True))
        power, v = np.linalg.eigh(_gram(y, search))
        power, v = np.maximum(power[::-1], 0), v[:, ::-1]
        running = np.cumsum(power) / max(everything, 1e-300)
        if running[-1] >= share - 1e-9 or search == steps:
            break
        search *= 2
    kept = int(np.searchsorted(running, min(share - 1e-12, running[-1]))) + 1
    kept = min(kept + kept % 2, len(power))  # whole pairs
    v, root = v[:, :kept], np.sqrt(np.maximum(power[:kept], 1e-300))
    scale = np.sqrt(1.0 / max(nodes, 1))  # coefficients carry the energy per node
    some = np.where(power[:kept] > 1e-14 * max(power[0], 1e-300), 1.0 / (root * scale), 0.0)
    modes = kept_at("modes", _unfolded(_mixed(y, "n_block", v * some), "n_block", place_n, "n_at", values, kept))
    a = _unfolded(_mixed(q, "s_block", v * root * scale), "s_block", place_s, "s_at", ["a"], kept)
    k = F.explode(F.sequence(F.lit(1), F.lit(kept))).alias("k")
    flat = modes.select(node, k, *values).select(node, "k", *[F.element_at(x, F.col("k")).alias(x) for x in values])
    sign = _signs(flat, values)
    flip = lambda df, cols: df.join(F.broadcast(sign), "k").select(*[(F.col(c) * F.col("_sign")).alias(c) if c in cols else F.col(c) for c in df.columns])
    return (power[:kept] / max(nodes, 1) / max(steps, 1)).tolist(), flip(flat, values), flip(a.select(step, k, "a").select(step, "k", F.element_at("a", F.col("k")).alias("a")), ["a"])


def _orthonormal(blocks: DataFrame, key: str, wide: int) -> DataFrame:
    """A matrix in blocks with orthonormal columns of the same span: by the small matrix's eigenvectors, twice for accuracy. Empty directions become zero."""
    for _ in range(2):
        power, v = np.linalg.eigh(_gram(blocks, wide))
        blocks = _mixed(blocks, key, v * np.where(power > 1e-24 * max(power[-1], 1e-300), 1.0 / np.sqrt(np.maximum(power, 1e-300)), 0.0))
    return blocks


def _signs(modes: DataFrame, values: list[str]) -> DataFrame:
    """(k, _sign): what makes the largest component of each mode positive."""
    peak = modes.groupBy("k").agg(*[F.max_by(v, F.abs(v)).alias(f"_p{v}") for v in values])
    largest = F.element_at(F.sort_array(F.array(*[F.struct(F.abs(f"_p{v}").alias("m"), F.col(f"_p{v}").alias("s")) for v in values]), asc=False), 1)["s"]
    return peak.select("k", F.when(largest < 0, -1.0).otherwise(1.0).alias("_sign"))


def pod(snapshots: DataFrame, node: str, step: str, values: list[str], share: float = 0.999, most_steps: int = 2048) -> tuple[list[float], DataFrame, DataFrame]:
    """Energies (with their running share), modes (node, k, one column per value) and coefficients (step, k, a), by the method of snapshots.

    The fluctuation about the time mean is taken per node; a node without a step does not move there. Each task adds up
    the inner products of its nodes in numpy, rows of these matrices are summed by row number, and only the one matrix, of
    a checked size, is decomposed on the driver. With more than ``most_steps`` steps, :func:`pod_of_many` finds the same modes.
    """
    steps = [r[0] for r in snapshots.select(step).distinct().orderBy(step).limit(most_steps + 1).collect()]
    if len(steps) > most_steps:
        return pod_of_many(snapshots, node, step, values, share)
    mean = snapshots.groupBy(node).agg(*[F.avg(v).alias(f"_m{v}") for v in values])
    moving = snapshots.join(mean, node).select(node, step, *[(F.col(v) - F.col(f"_m{v}")).alias(v) for v in values])
    place = snapshots.sparkSession.createDataFrame([(s, k) for k, s in enumerate(steps)], f"`{step}` {dict(snapshots.dtypes)[step]}, _k int")
    per_node = moving.join(F.broadcast(place), step).groupBy(node).agg(F.collect_list("_k").alias("at"), F.collect_list(F.array(*[F.col(v).cast("double") for v in values])).alias("x"))  # at most ``most_steps`` entries
    nodes = per_node.count()
    rows = per_node.select("at", "x").mapInArrow(_inner_products(len(steps), len(values)), "i int, c binary").groupBy("i").applyInArrow(_added, "i int, c binary").toArrow()
    matrix = np.zeros((len(steps), len(steps)))
    for i, c in zip(rows.column("i").to_pylist(), rows.column("c").to_pylist(), strict=True):
        matrix[i] = np.frombuffer(c) / nodes
    power, vectors = np.linalg.eigh(matrix / len(steps))
    power, vectors = np.maximum(power[::-1], 0), vectors[:, ::-1]
    cumulative = np.cumsum(power) / max(power.sum(), 1e-300)
    kept = int(np.searchsorted(cumulative, share - 1e-12)) + 1
    kept = min(kept + kept % 2, len(power))  # whole pairs
    a = vectors[:, :kept] * np.sqrt(power[:kept] * len(steps))
    spark = snapshots.sparkSession
    coefficients = spark.createDataFrame([(steps[i], k + 1, float(a[i, k])) for i in range(len(steps)) for k in range(kept)], f"`{step}` {dict(snapshots.dtypes)[step]}, k int, a double")
    scale = spark.createDataFrame([(k + 1, float(power[k] * len(steps))) for k in range(kept)], "k int, _e double").filter("_e > 0")
    modes = moving.join(coefficients, step).groupBy(node, "k").agg(*[F.sum(F.col(v) * F.col("a")).alias(v) for v in values]).join(F.broadcast(scale), "k").select(node, "k", *[(F.col(v) / F.col("_e")).alias(v) for v in values])
    sign = _signs(modes, values)
    flip = lambda df, cols: df.join(F.broadcast(sign), "k").select(*[(F.col(c) * F.col("_sign")).alias(c) if c in cols else F.col(c) for c in df.columns])
    return power[:kept].tolist(), flip(modes, values), flip(coefficients, ["a"])


def reconstruct(modes: DataFrame, coefficients: DataFrame, node: str, step: str, values: list[str], mean: DataFrame | None = None) -> DataFrame:
    """sum over k of a_k m_k per node and step, plus the mean if given."""
    out = modes.join(coefficients, "k").groupBy(node, step).agg(*[F.sum(F.col(v) * F.col("a")).alias(v) for v in values])
    if mean is None:
        return out
    base = mean.select(node, *[F.col(v).alias(f"_m{v}") for v in values])
    return out.join(base, node).select(node, step, *[(F.col(v) + F.col(f"_m{v}")).alias(v) for v in values])


def linear_extrapolation(df: DataFrame, key: list[str], x: str, y: str, at: float = 0.0) -> DataFrame:
    return df.groupBy(*key).agg((F.regr_intercept(y, x) + F.regr_slope(y, x) * at).alias("extrapolated"))


def log_interpolation(df: DataFrame, key: list[str], x: str, y: str, at: float) -> DataFrame:
    """Between the two points around ``at``, linear in ln(x)."""
    lo = df.filter(F.col(x) <= at).groupBy(*key).agg(F.max(F.struct(x, y)).alias("_l"))
    hi = df.filter(F.col(x) >= at).groupBy(*key).agg(F.min(F.struct(x, y)).alias("_h"))
    both = lo.join(hi, key) if key else lo.crossJoin(hi)
    t = F.when(F.col(f"_h.{x}") > F.col(f"_l.{x}"), (F.ln(F.lit(float(at))) - F.ln(f"_l.{x}")) / (F.ln(f"_h.{x}") - F.ln(f"_l.{x}"))).otherwise(0.0)
    return both.select(*key, (F.col(f"_l.{y}") + t * (F.col(f"_h.{y}") - F.col(f"_l.{y}"))).alias("value"))


def decay_fit(df: DataFrame, key: list[str], step: str, value: str) -> DataFrame:
    """Steps per e-fold from the slope of ln |value|."""
    return df.filter(F.col(value) != 0).groupBy(*key).agg((-1 / F.regr_slope(F.ln(F.abs(value)), F.col(step).cast("double"))).alias("steps_per_fold"))
