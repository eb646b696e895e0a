"""Statistics over windows of a history and the decision when to stop.

A history is long: run, signal, position (0-based sample number) or iteration, value. Windows hold a fixed number of
samples; a short last window is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Constants of the gate: cycles needed, drift over standard error, log ratio of sds, hysteresis in sds, flatness, windows at most.
MIN_CYCLES, K_GATE, K_SD, HYSTERESIS, FLAT, MOST = 10, 2.0, 3.0, 0.1, 1e-4, 7
INF = float("inf")


def windowed(history: DataFrame, size: int, position: str = "i") -> DataFrame:
    return history.withColumn("window", F.floor(F.col(position) / size).cast("bigint"))


def discard(history: DataFrame, key: list[str], first: int, position: str = "i") -> DataFrame:
    """The history behind a transient: positions after ``first``, numbered anew from zero."""
    return history.filter(F.col(position) > F.lit(first)).withColumn(position, F.col(position) - F.lit(first + 1))


def on_grid(history: DataFrame, key: list[str], step: int, position: str) -> DataFrame:
    """Whether the positions of a run are step, 2 step, 3 step, ...: rows, last, regular."""
    out = history.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"), F.max(position).alias("last"), F.count_distinct(position).alias("_d"), F.bool_and(F.pmod(position, F.lit(step)) == 0).alias("_m"), F.min(position).alias("_f"))
    return out.withColumn("regular", F.col("_m") & (F.col("_d") == F.col("rows")) & (F.col("_f") == step) & (F.col("last") == F.col("rows") * step)).drop("_d", "_m", "_f")


def window_stats(history: DataFrame, size: int, key: list[str], position: str = "i", value: str = "value") -> DataFrame:
    """Per key and full window: n, mean, sd (n - 1), least, most."""
    out = windowed(history, size, position).groupBy(*key, "window").agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.min(value).alias("least"), F.max(value).alias("most")
    )
    return out.filter(F.col("n") == size)


def schmitt_cycles(history: DataFrame, stats: DataFrame, size: int, key: list[str], position: str = "i", value: str = "value", hysteresis: float = HYSTERESIS) -> DataFrame:
    """Cycles per full window: half the crossings of the mean with a dead band of ``hysteresis`` sds. The first excursion is no crossing."""
    rows = windowed(history, size, position).join(stats.select(*key, "window", "mean", "sd"), [*key, "window"])
    band = F.lit(hysteresis) * F.col("sd")
    state = F.when(F.col(value) > F.col("mean") + band, 1).when(F.col(value) < F.col("mean") - band, -1)
    order = Window.partitionBy(*key, "window").orderBy(position)
    moved = rows.withColumn("state", state).filter(F.col("state").isNotNull()).withColumn("before", F.lag("state").over(order))
    crossings = moved.groupBy(*key, "window").agg(F.count_if(F.col("before") != F.col("state")).alias("crossings"))
    return stats.join(crossings, [*key, "window"], "left").withColumn("crossings", F.coalesce("crossings", F.lit(0))).withColumn("cycles", F.floor(F.col("crossings") / 2).cast("bigint"))


def stationarity_gate(stats: DataFrame, key: list[str], min_cycles: int = MIN_CYCLES, k_gate: float = K_GATE, k_sd: float = K_SD) -> DataFrame:
    """Each window against the one before: drift, drift over its standard error, log ratio of sds over its tolerance, passed."""
    before = F.lag(F.struct("mean", "sd", "cycles")).over(Window.partitionBy(*key).orderBy("window"))
    rows = stats.withColumn("p", before).filter(F.col("p").isNotNull())
    n = F.least(F.col("p.cycles"), F.col("cycles"))
    enough = n >= min_cycles
    drift = F.col("mean") - F.col("p.mean")
    se = F.sqrt((F.col("p.sd") * F.col("p.sd") + F.col("sd") * F.col("sd")) / n)
    over = F.when(se > 0, F.abs(drift) / se).when(drift == 0, 0.0).otherwise(F.lit(INF))
    ratio = F.when((F.col("p.sd") > 0) & (F.col("sd") > 0), F.abs(F.ln(F.col("sd") / F.col("p.sd")))).otherwise(F.lit(INF)) / (F.lit(k_sd) / F.sqrt(n))
    out = rows.withColumn("drift", drift).withColumn("drift_over_se", F.when(enough, over)).withColumn("sd_ratio_over_tol", F.when(enough, ratio))
    passed = F.coalesce((F.col("drift_over_se") <= k_gate) & (F.col("sd_ratio_over_tol") <= 1), F.lit(False))
    return out.select(*key, "window", "drift", "drift_over_se", "sd_ratio_over_tol", passed.alias("passed"))


def first_offender(history: DataFrame, key: list[str], bad: Column, position: str = "i") -> DataFrame:
    """Position of the first row that is not allowed, per key (only keys that have one)."""
    return history.filter(bad).groupBy(*key).agg(F.min(position).alias("diverged_at"))


def stop_decision(stats: DataFrame, gate: DataFrame, run: list[str], signal: list[str], size: int, offenders: DataFrame | None = None, flat: float = FLAT, most: int = MOST) -> DataFrame:
    """Per run the verdict that fires first: diverged, converged, stationary, or no_steady_state at the cap; its window and the last position read.

    A verdict needs all signals of the run. Within a window the order above decides. Runs where nothing fires are unfinished.
    """
    calm = F.col("sd") <= F.lit(flat) * F.greatest(F.abs(F.col("mean")), F.lit(1.0))
    per = stats.groupBy(*run, "window").agg(F.bool_and(calm).alias("calm"))
    gates = gate.groupBy(*run, "window").agg(F.bool_and("passed").alias("passed"))
    rows = per.join(gates, [*run, "window"], "left")
    rank = F.when(F.col("calm"), 1).when(F.coalesce("passed", F.lit(False)), 2).when(F.col("window") + 1 >= most, 3)
    fired = rows.withColumn("rank", rank).filter(F.col("rank").isNotNull()).select(*run, "window", "rank", ((F.col("window") + 1) * size - 1).alias("at"))
    if offenders is not None:
        fired = fired.unionByName(offenders.select(*run, F.floor(F.col("diverged_at") / size).cast("bigint").alias("window"), F.lit(0).alias("rank"), F.col("diverged_at").alias("at")))
    first = fired.groupBy(*run).agg(F.min(F.struct("window", "rank", "at")).alias("v"))
    names = F.element_at(F.array(*map(F.lit, ["diverged", "converged", "stationary", "no_steady_state"])), F.col("v.rank") + 1)
    out = stats.select(*run).distinct().join(first, run, "left")
    fired_at_all = F.col("v").isNotNull()
    return out.select(*run, F.when(fired_at_all, names).otherwise("unfinished").alias("status"), F.when(fired_at_all, F.col("v.window")).alias("window"), F.when(fired_at_all, F.col("v.at")).alias("stopped_at"))


def moving_stop(history: DataFrame, key: list[str], position: str, across: str, up: str, target: float, tolerance: float = 5.0, width: int = 7) -> DataFrame:
    """Per key where the direction of the moving means of two components first comes within ``tolerance`` degrees of ``target``.

    stopped_at and angle (of that row); reason is ``angle``, or ``end`` with the last row where it never does. Means over
    fewer than ``width`` rows don't count.
    """
    last = Window.partitionBy(*key).orderBy(position).rowsBetween(1 - width, 0)
    rows = history.withColumn("_n", F.count(F.lit(1)).over(last)).withColumn("_angle", F.degrees(F.atan2(F.avg(up).over(last), F.avg(across).over(last))))
    away = F.col("_angle") - F.lit(target)
    near = (F.col("_n") >= width) & (F.abs(away - F.lit(360.0) * F.round(away / 360)) <= tolerance)
    out = rows.groupBy(*key).agg(F.min(F.when(near, F.struct(F.col(position).alias("at"), F.col("_angle").alias("angle")))).alias("hit"), F.max(F.struct(F.col(position).alias("at"), F.col("_angle").alias("angle"))).alias("end"))
    pick = F.coalesce("hit", "end")
    return out.select(*key, F.when(F.col("hit").isNotNull(), "angle").otherwise("end").alias("reason"), pick["at"].alias("stopped_at"), pick["angle"].alias("angle"))


def pooled_publish(history: DataFrame, decision: DataFrame, size: int, run: list[str], signal: list[str], position: str = "i", value: str = "value") -> DataFrame:
    """Per run and signal the published value: over all closed windows (mean, sd, min, max), or the last sample if the run converged or diverged."""
    rows = history.join(decision, run).filter(F.col("stopped_at").isNotNull() & (F.col(position) <= F.col("stopped_at")))
    single = F.col("status").isin("converged", "diverged")
    return rows.groupBy(*run, *[s for s in signal if s not in run], "status").agg(
        F.when(F.first(single), F.max_by(value, position)).otherwise(F.avg(value)).alias("published"),
        F.when(~F.first(single), F.stddev_samp(value)).alias("sd"),
        F.min(value).alias("least"), F.max(value).alias("most"), F.count(value).alias("samples"),
        F.floor((F.max(position) + 1) / size).cast("bigint").alias("windows"),
    )
