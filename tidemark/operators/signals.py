"""Time signals: crossings, whole-period windows, trapezoidal statistics, phase averages and spectra.

A signal is key columns, ``t`` and ``y``. Order matters within time buckets only, and what a bucket needs from the one
before is carried over (:mod:`tidemark.operators.ordered`); everything else is projections, grouped sums and equi-joins
on time buckets. So neither a window nor a group holds a whole series, and there is no range join; spectra sum per bin.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import SAMPLES, beside, bucketed, numbered, placed, running_sum


def about_mean(signal: DataFrame, key: list[str]) -> DataFrame:
    means = signal.groupBy(*key).agg(F.avg("y").alias("_mean"))
    return with_group(signal, means, key).withColumn("y", F.col("y") - F.col("_mean")).drop("_mean")


def with_group(rows: DataFrame, groups: DataFrame, key: list[str]) -> DataFrame:
    """Rows with the values of their group, one row per key."""
    return rows.join(groups, key) if key else rows.crossJoin(F.broadcast(groups))  # one row


def search_window(signal: DataFrame, key: list[str], t0: float, t1: float) -> DataFrame:
    """Samples within [t0, t1] (and a millionth of a step), with ``spans`` false where the signal does not reach both ends within half a step."""
    first = signal.groupBy(*key).agg(F.min("t").alias("_t0"), F.max("t").alias("_t1"))
    second = with_group(signal, first, key).filter(F.col("t") > F.col("_t0")).groupBy(*key).agg(F.min("t").alias("_t2"))
    ends = first.join(second, key, "left") if key else first.join(F.broadcast(second), how="cross")
    step = F.col("_t2") - F.col("_t0")
    reach = (F.col("_t0") <= F.lit(t0) + step / 2) & (F.col("_t1") >= F.lit(t1) - step / 2)
    rows = with_group(signal, ends.select(*key, step.alias("_step"), reach.alias("spans")), key)
    return rows.filter(F.col("t").between(F.lit(t0) - 1e-6 * F.col("_step"), F.lit(t1) + 1e-6 * F.col("_step"))).drop("_step")


def upward_crossings(signal: DataFrame, key: list[str]) -> DataFrame:
    """Times where y passes zero upwards, linear between samples: key, k (0-based), t_cross."""
    rows, _ = bucketed(signal, key)
    rows = beside(rows, key, "t", {"_t0": "t", "_y0": "y"})
    hit = rows.filter((F.col("_y0") < 0) & (F.col("y") >= 0))
    at = F.col("_t0") + (F.col("t") - F.col("_t0")) * (-F.col("_y0")) / (F.col("y") - F.col("_y0"))
    out = numbered(hit.withColumn("t_cross", at), key, ["t_cross"], F.col("_bucket"), "k")
    return out.select(*key, "t_cross", F.col("k").cast("bigint").alias("k"))


def with_next(crossings: DataFrame, key: list[str], name: str = "_next") -> DataFrame:
    """Crossings with the time of the one behind; the last has none and is left out."""
    behind = crossings.select(*key, (F.col("k") - 1).alias("k"), F.col("t_cross").alias(name))
    return crossings.join(behind, [*key, "k"])


def period_window(crossings: DataFrame, key: list[str]) -> DataFrame:
    """Whole periods: first and last crossing, their number, frequency. Keys with fewer than two crossings have no window."""
    out = crossings.groupBy(*key).agg(F.min("t_cross").alias("t_start"), F.max("t_cross").alias("t_end"), (F.count(F.lit(1)) - 1).alias("periods"))
    return out.filter(F.col("periods") >= 1).withColumn("frequency", F.col("periods") / (F.col("t_end") - F.col("t_start")))


def period_lengths(crossings: DataFrame, key: list[str]) -> DataFrame:
    """Mean, sd, first and last length of the cycles, and their number."""
    rows = with_next(crossings, key).withColumn("length", F.col("_next") - F.col("t_cross"))
    return rows.groupBy(*key).agg(F.avg("length").alias("mean_length"), F.stddev_samp("length").alias("sd_length"), F.min_by("length", "k").alias("first_length"), F.max_by("length", "k").alias("last_length"), F.count(F.lit(1)).alias("cycles"))


def segments(signal: DataFrame, key: list[str]) -> DataFrame:
    """Neighbouring samples as t, y, t1, y1."""
    rows, _ = bucketed(signal, key)
    return beside(rows, key, "t", {"t1": "t", "y1": "y"}, ahead=True).drop("_bucket").filter(F.col("t1").isNotNull())


def trapezoid_stats(signal: DataFrame, spans: DataFrame, key: list[str], span: list[str]) -> DataFrame:
    """Time mean and rms of the fluctuation over [a, b] of each span, by the trapezoidal rule with interpolated ends.

    ``spans``: key columns, span columns, a, b; a handful per key, so the join on the key does not multiply the signal much.
    """
    s = segments(signal, key).join(spans, key).filter((F.col("t1") > F.col("a")) & (F.col("t") < F.col("b")))
    slope = (F.col("y1") - F.col("y")) / (F.col("t1") - F.col("t"))
    lo, hi = F.greatest("t", "a"), F.least("t1", "b")
    s = s.withColumn("_lo", lo).withColumn("_hi", hi).withColumn("_u", F.col("y") + slope * (F.col("_lo") - F.col("t"))).withColumn("_v", F.col("y") + slope * (F.col("_hi") - F.col("t")))
    h, u, v = F.col("_hi") - F.col("_lo"), F.col("_u"), F.col("_v")
    out = s.groupBy(*key, *span).agg(F.sum(h).alias("_h"), F.sum(h * (u + v) / 2).alias("_s"), F.sum(h * (u * u + v * v) / 2).alias("_q"))
    mean = F.col("_s") / F.col("_h")
    return out.select(*key, *span, mean.alias("time_mean"), F.sqrt(F.greatest(F.col("_q") / F.col("_h") - mean * mean, F.lit(0.0))).alias("time_rms"))


def cycles_of(signal: DataFrame, crossings: DataFrame, key: list[str]) -> DataFrame:
    """Samples with the number of their cycle; samples outside the whole periods are dropped. Crossings are merged into the time order, not joined."""
    rows, bounds = bucketed(signal.select(*key, "t", "y"), key)
    marks = placed(crossings.select(*key, F.col("t_cross").alias("t"), F.lit(None).cast("double").alias("y")), bounds, key)
    both = rows.withColumn("_mark", F.lit(0)).unionByName(marks.withColumn("_mark", F.lit(1)))
    total = crossings.groupBy(*key).agg(F.count(F.lit(1)).alias("_all"))
    out = running_sum(both, key, ["t", F.col("_mark").desc()], "_mark", "cycle").withColumn("cycle", (F.col("cycle") - 1).cast("bigint"))
    out = with_group(out.filter(F.col("_mark") == 0), total, key)
    return out.filter((F.col("cycle") >= 0) & (F.col("cycle") < F.col("_all") - 1)).select(*key, "t", "y", "cycle")


def peak_to_peak(signal: DataFrame, crossings: DataFrame, key: list[str]) -> DataFrame:
    """Mean over the cycles of max - min (the signal is about its mean, so both ends of a cycle are zero), and half of it."""
    per = cycles_of(signal, crossings, key).groupBy(*key, "cycle").agg((F.greatest(F.max("y"), F.lit(0.0)) - F.least(F.min("y"), F.lit(0.0))).alias("_p"))
    return per.groupBy(*key).agg(F.avg("_p").alias("peak_to_peak"), (F.avg("_p") / 2).alias("amplitude"), F.count(F.lit(1)).alias("cycles"))


def half_spans(crossings: DataFrame, key: list[str]) -> DataFrame:
    """The first and the last floor(n / 2) periods; with an odd number the middle one belongs to neither."""
    rows = with_group(crossings, crossings.groupBy(*key).agg(F.max("k").alias("_n")), key).withColumn("_h", F.floor(F.col("_n") / 2))
    at = lambda k: F.max(F.when(F.col("k") == k, F.col("t_cross")))
    ends = rows.groupBy(*key).agg(F.max("_n").alias("periods"), at(F.lit(0)).alias("c0"), at(F.col("_h")).alias("ch"), at(F.col("_n") - F.col("_h")).alias("cm"), at(F.col("_n")).alias("cn"))
    two = F.inline(F.array(F.struct(F.lit("first").alias("half"), F.col("c0").alias("a"), F.col("ch").alias("b")), F.struct(F.lit("second").alias("half"), F.col("cm").alias("a"), F.col("cn").alias("b"))))
    return ends.select(*key, "periods", two)


def halves_test(signal: DataFrame, crossings: DataFrame, key: list[str], tolerance: float = 1e-3, least: int = 4) -> DataFrame:
    """Mean and rms of both halves, their change relative to the whole window, and whether both stay below the tolerance."""
    spans = half_spans(crossings, key)
    whole = crossings.groupBy(*key).agg(F.lit("whole").alias("half"), F.min("t_cross").alias("a"), F.max("t_cross").alias("b"))
    stats = trapezoid_stats(signal, spans.drop("periods").unionByName(whole.select(*key, "half", "a", "b")), key, ["half"])
    pick = lambda h, c: F.max(F.when(F.col("half") == h, F.col(c)))
    wide = stats.groupBy(*key).agg(*[pick(h, c).alias(f"{h}_{n}") for h in ("first", "second", "whole") for c, n in (("time_mean", "mean"), ("time_rms", "rms"))])
    change = lambda n: F.when(F.col(f"whole_{n}") == 0, F.lit(math.inf)).otherwise(F.abs(F.col(f"second_{n}") - F.col(f"first_{n}")) / F.abs(F.col(f"whole_{n}")))
    out = wide.join(spans.select(*key, "periods").distinct(), key).withColumn("mean_change", change("mean")).withColumn("rms_change", change("rms"))
    return out.withColumn("passed", (F.col("periods") >= least) & (F.col("mean_change") < tolerance) & (F.col("rms_change") < tolerance))


def interp_at(signal: DataFrame, queries: DataFrame, key: list[str], width: float, at: str = "tq") -> DataFrame:
    """y at the times ``at`` of ``queries``, linear between samples, by an equi-join on time buckets.

    Times outside the samples take the nearest end's value. ``width`` is a few sample steps.
    """
    ends = signal.groupBy(*key).agg(F.min("t").alias("_lo"), F.max("t").alias("_hi"))
    s = with_group(segments(signal, key), ends.select(*key, "_hi"), key).withColumn("_last", F.col("t1") == F.col("_hi")).drop("_hi")
    s = s.withColumn("_b", F.explode(F.sequence(F.floor(F.col("t") / width), F.floor(F.col("t1") / width))))
    q = with_group(queries, ends, key).withColumn("_c", F.least(F.greatest(F.col(at), F.col("_lo")), F.col("_hi"))).withColumn("_b", F.floor(F.col("_c") / width))
    hit = q.join(s, [*key, "_b"]).filter((F.col("_c") >= F.col("t")) & ((F.col("_c") < F.col("t1")) | F.col("_last") & (F.col("_c") == F.col("t1"))))
    y = F.col("y") + (F.col("y1") - F.col("y")) * (F.col("_c") - F.col("t")) / (F.col("t1") - F.col("t"))
    return hit.withColumn("yq", y).select(*queries.columns, "yq")


def phase_average(signal: DataFrame, crossings: DataFrame, key: list[str], phases: int, width: float) -> DataFrame:
    """Per phase j / phases: mean and sd (n - 1) over the cycles of the interpolated signal."""
    q = with_next(crossings, key).withColumn("phase_no", F.explode(F.sequence(F.lit(0), F.lit(phases - 1)))).select(*key, "k", "phase_no", (F.col("t_cross") + (F.col("_next") - F.col("t_cross")) * F.col("phase_no") / phases).alias("tq"))
    return interp_at(signal, q, key, width).groupBy(*key, "phase_no").agg(F.avg("yq").alias("mean"), F.stddev_samp("yq").alias("sd"), F.count(F.lit(1)).alias("cycles"))


def linear_resample(signal: DataFrame, spans: DataFrame, key: list[str], n: int, width: float) -> DataFrame:
    """n even points of [a, b) per key: i, tq, yq."""
    q = spans.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).select(*key, "i", (F.col("a") + (F.col("b") - F.col("a")) * F.col("i") / n).alias("tq"))
    return interp_at(signal, q, key, width)


def spectrum(even: DataFrame, key: list[str], bins: int, y: str = "y", weight: Column | None = None, padding: int = 1) -> DataFrame:
    """One-sided power of evenly sampled rows (column ``i``): bins 1..bins of the DFT about the mean; all bins together sum to the variance.

    The bins are exploded map-side and summed before the shuffle, so the exchange carries one row per bin and task.
    ``padding``: as if zeros behind the rows made them so many times longer; the bins lie that much closer together.
    """
    sums = even.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.avg(y).alias("_m"))
    rows = with_group(even, sums, key).withColumn("_y", (F.col(y) - F.col("_m")) * (F.lit(1.0) if weight is None else weight))
    rows = rows.withColumn("bin", F.explode(F.sequence(F.lit(1), F.least(F.lit(bins), F.floor(padding * F.col("_n") / 2).cast("int")))))
    angle = F.lit(2 * math.pi) * F.pmod(F.col("bin") * F.col("i"), padding * F.col("_n")) / (padding * F.col("_n"))  # reduced exactly before the cosine
    out = rows.groupBy(*key, "bin").agg(F.max("_n").alias("_n"), F.sum(F.col("_y") * F.cos(angle)).alias("_c"), F.sum(F.col("_y") * F.sin(angle)).alias("_s"))
    one_sided = F.when(2 * F.col("bin") == padding * F.col("_n"), 1.0).otherwise(2.0)  # the Nyquist bin is not doubled
    return out.select(*key, F.col("bin").cast("bigint").alias("bin"), (one_sided * (F.col("_c") * F.col("_c") + F.col("_s") * F.col("_s")) / (F.col("_n") * F.col("_n"))).alias("power"))


def hann_spectrum(even: DataFrame, key: list[str], bins: int, y: str = "y", padding: int = 1) -> DataFrame:
    """As :func:`spectrum` with a Hann taper, normalised to its largest bin. A padding of 8 shows a peak between the bins of the rows alone."""
    counted = with_group(even, even.groupBy(*key).agg(F.count(F.lit(1)).alias("_all")), key)
    tapered = counted.withColumn("_taper", F.lit(0.5) - F.lit(0.5) * F.cos(F.lit(2 * math.pi) * F.col("i") / (F.col("_all") - 1))).drop("_all")
    out = spectrum(tapered, key, bins, y, F.col("_taper"), padding)
    return out.withColumn("power", F.col("power") / F.max("power").over(Window.partitionBy(*key)))


def moving_mean(signal: DataFrame, key: list[str], width: int) -> DataFrame:
    """Centred running sum over the width, zero padded at both ends."""
    back, fore = width // 2, width - 1 - width // 2
    rows, _ = bucketed(signal, key)
    rows = numbered(rows, key, ["t"], F.col("_bucket"), "_i")
    size = max(SAMPLES, width)
    # Rows near the end of a block also go to the next one, where they only take part in sums.
    blocks = F.array_distinct(F.transform(F.array(F.col("_i") - fore, F.col("_i"), F.col("_i") + back), lambda i: F.floor(i / size)))
    dealt = rows.withColumn("_block", F.explode(blocks))
    w = Window.partitionBy(*key, "_block").orderBy("_i").rowsBetween(-back, fore)
    out = dealt.withColumn("smooth", F.sum("y").over(w) / width).filter(F.col("_block") == F.floor(F.col("_i") / size))
    return out.drop("_i", "_block")


def fft_lowpass(signal: DataFrame, key: list[str], period: float, pad: int = 300) -> DataFrame:
    """Zero-phase low-pass of even samples: mirrored padding, no frequencies above 1 / period. One key per group; the transform needs the whole signal."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t")
        y = pdf["y"].to_numpy(float)
        k = min(pad, len(y) - 1)
        wide = np.concatenate([2 * y[0] - y[k:0:-1], y, 2 * y[-1] - y[-2 : -k - 2 : -1]]) if k > 0 else y
        dt = float(np.median(np.diff(pdf["t"]))) if len(y) > 1 else 1.0
        f = np.fft.rfft(wide)
        f[np.fft.rfftfreq(len(wide), dt) > 1 / period] = 0
        return pdf.assign(smooth=np.fft.irfft(f, len(wide))[k : k + len(y)])

    schema = signal.schema.simpleString()[7:-1] + ",smooth:double"
    return signal.groupBy(*key).applyInPandas(one, schema.replace(",", ", ").replace(":", " ")) if key else signal.groupBy(F.lit(0).alias("_g")).applyInPandas(one, schema.replace(",", ", ").replace(":", " "))


def reconstruct_at(phase_means: DataFrame, queries: DataFrame, key: list[str], phases: int) -> DataFrame:
    """The signal at time ``tq`` from its phase average and the window [a, b] of ``periods`` periods, linear and periodic."""
    place = F.pmod((F.col("tq") - F.col("a")) / (F.col("b") - F.col("a")) * F.col("periods"), F.lit(1.0)) * phases
    q = queries.withColumn("_p", place).withColumn("_j", F.floor("_p").cast("int"))
    here = phase_means.select(*key, F.col("phase_no").alias("_j"), F.col("mean").alias("_m0"))
    there = phase_means.select(*key, F.pmod(F.col("phase_no") - 1, F.lit(phases)).cast("int").alias("_j"), F.col("mean").alias("_m1"))
    hit = q.join(here, [*key, "_j"]).join(there, [*key, "_j"])
    return hit.withColumn("yq", F.col("_m0") + (F.col("_m1") - F.col("_m0")) * (F.col("_p") - F.col("_j"))).select(*queries.columns, "yq")


def phase_lag(phase_means: DataFrame, key: list[str], signal: str, reference: str, phases: int) -> DataFrame:
    """Crest phase of every signal minus that of the reference, on the circle in (-0.5, 0.5]."""
    crest = phase_means.groupBy(*key, signal).agg(F.max_by("phase_no", F.struct(F.col("mean"), -F.col("phase_no"))).alias("crest"))
    base = crest.filter(F.col(signal) == reference).select(*key, F.col("crest").alias("_base"))
    lag = 0.5 - F.pmod(F.lit(0.5) - (F.col("crest") - F.col("_base")) / phases, F.lit(1.0))
    joined = crest.join(base, key) if key else crest.crossJoin(base)
    return joined.select(*key, signal, (F.col("crest") / phases).alias("crest_phase"), lag.alias("lag"))


def scale(df: DataFrame, columns: list[str], by: Column) -> DataFrame:
    """Columns over a reference quantity (value and deviation alike); null where that is missing or zero."""
    return df.withColumns({c: F.when(by != 0, F.col(c) / by) for c in columns})


def within(df: DataFrame, **bounds: tuple[float, float]) -> DataFrame:
    """Rows whose columns all lie within their bounds, both ends closed."""
    for c, (lo, hi) in bounds.items():
        df = df.filter(F.col(c).between(lo, hi))
    return df


def variance_below(spectrum: DataFrame, key: list[str], frequency: str, power: str, most: float) -> DataFrame:
    """Number of bins up to a frequency, the variance that they carry, and its share of all bins'."""
    low = F.col(frequency) <= F.lit(most)
    return spectrum.groupBy(*key).agg(F.count_if(low).alias("bins"), F.sum(F.when(low, F.col(power)).otherwise(0.0)).alias("variance"), (F.sum(F.when(low, F.col(power)).otherwise(0.0)) / F.sum(power)).alias("share"))


def lateral_trend(points: DataFrame, key: list[str], x: str, most: float) -> DataFrame:
    """Points up to a limit, numbered by their place along x."""
    order = Window.partitionBy(*key).orderBy(x)
    return points.filter(F.col(x) <= F.lit(most)).withColumn("place", F.row_number().over(order))


def rms_about_mean(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """Root mean square of the fluctuation about the mean (population)."""
    return df.groupBy(*key).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("rms"))


def settled(signal: DataFrame, key: list[str], least: float, margin: float = 0.01) -> DataFrame:
    """Samples after max(first + margin, least)."""
    first = signal.groupBy(*key).agg(F.greatest(F.min("t") + margin, F.lit(least)).alias("_t0"))
    return with_group(signal, first, key).filter(F.col("t") > F.col("_t0")).drop("_t0")

