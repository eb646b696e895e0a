"""Scalar expressions shared by the operators. All take and return columns and stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison between engines; never a negative zero."""
    return F.round(col(c).cast("double"), digits) + F.lit(0.0)


def close(a: Column | str, b: Column | str, tolerance: float = 1e-9) -> Column:
    """Equal within a relative tolerance with floor 1. Two values that are not finite (or null) count as equal."""
    a, b = col(a), col(b)
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(odd(a) | odd(b), odd(a) & odd(b)).otherwise(F.abs(a - b) <= F.lit(tolerance) * F.greatest(F.lit(1.0), F.abs(a), F.abs(b)))


def relative(a: Column | str, b: Column | str, floor: float = 1e-30) -> Column:
    """|a - b| over the larger magnitude, with a floor."""
    a, b = col(a), col(b)
    return F.abs(a - b) / F.greatest(F.abs(a), F.abs(b), F.lit(floor))


def relative_change(first: Column | str, second: Column | str, whole: Column | str) -> Column:
    """|second - first| / |whole|; infinite if ``whole`` is zero."""
    w = col(whole)
    return F.when(w == 0, F.lit(float("inf"))).otherwise(F.abs(col(second) - col(first)) / F.abs(w))


def practically_zero(a: Column | str, limit: float = 1e-9) -> Column:
    return F.abs(col(a)) <= F.lit(limit)


def reduce90(angle: Column | str) -> Column:
    """An axis angle in degrees, reduced to (-90, 90]."""
    r = F.pmod(col(angle) + 90, F.lit(180.0)) - 90
    return F.when(r == -90, F.lit(90.0)).otherwise(r)


def shown(angle: Column | str, digits: int = 0) -> Column:
    """The reduced angle as displayed: rounding may carry it to -90, which shows as 90."""
    r = F.round(reduce90(angle), digits)
    return F.when(r <= -90, F.lit(90.0)).otherwise(r)


def two_significant(v: Column | str) -> Column:
    """Rounded half-even to two significant figures, steps of at least 1; zero for what isn't positive."""
    v = col(v)
    m = F.greatest(F.lit(1.0), F.pow(F.lit(10.0), F.length(F.floor(v).cast("string")) - 2))
    return F.when(v <= 0, F.lit(0)).otherwise((F.bround(v / m) * m).cast("bigint"))


def tokens_of(characters: Column | str, rate: float = 2.5) -> Column:
    """Characters over the rate, rounded half-even."""
    return F.bround(col(characters) / F.lit(rate)).cast("bigint")


def level_value(level: Column | str, low: Column | str, high: Column | str, levels: int = 256) -> Column:
    """What one step of a colour bar of so many levels stands for, times ``level``."""
    return col(level) * (col(high) - col(low)) / F.lit(levels)


def grey(r: Column | str, g: Column | str, b: Column | str) -> Column:
    return (col(r) + col(g) + col(b)) / 3


def is_grey(r: Column | str, g: Column | str, b: Column | str) -> Column:
    return F.greatest(col(r), col(g), col(b)) == F.least(col(r), col(g), col(b))


def hash_uniform(*keys: Column | str, seed: int = 42) -> Column:
    """A uniform number in (0, 1) that depends on the keys and the seed alone, not on partitioning."""
    text = F.concat_ws("|", F.lit(str(seed)), *[col(k).cast("string") for k in keys])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)


def drag_correlation(re: Column | str, a: float, b: float, c: float, d: float, e: float) -> Column:
    """24 / Re (1 + a Re^b) + c / (1 + d Re^e)."""
    re = col(re)
    return F.lit(24.0) / re * (1 + F.lit(a) * F.pow(re, F.lit(b))) + F.lit(c) / (1 + F.lit(d) * F.pow(re, F.lit(e)))


#: Fixed values of the published fit of the shedding frequency.
STROUHAL = (-3.3265, 0.1816, 1.6e-4)


def strouhal_correlation(re: Column | str, fit: tuple[float, float, float] = STROUHAL) -> Column:
    re = col(re)
    return F.lit(fit[0]) / re + F.lit(fit[1]) + F.lit(fit[2]) * re


def percent_error(value: Column | str, reference: Column | str) -> Column:
    return F.when(col(reference) == 0, None).otherwise((col(value) - col(reference)) / col(reference) * 100)


def nearest_face(angle: Column | str, faces: list[float]) -> Column:
    """Of some angles (degrees) the one with the least reduced distance to ``angle``; of equals the first."""
    a = col(angle)
    return F.array_min(F.array(*[F.struct(F.abs(reduce90(a - F.lit(float(f)))).alias("away"), F.lit(k).alias("k"), F.lit(float(f)).alias("face")) for k, f in enumerate(faces)]))["face"]


def over_flux(flow: Column | str, density: Column | str, velocity: Column | str, side: Column | str) -> Column:
    """A mass flow over density, velocity and the square of a side; null if any reference is missing or zero."""
    scale = col(density) * col(velocity) * col(side) * col(side)
    return F.when(scale != 0, col(flow) / scale)


#: How the reason of each final status reads.
STOP_REASONS = {
    "stationary": r"Window statistics of cd, cl, cy, cp_base stationary between iterations \d+-\d+ and \d+-\d+ \(max drift/SE = [-+0-9.Ee]+\)\.",
    "no_steady_state": r"Reached \d+ iterations; (cd|cl|cy|cp_base) failed the stationarity gate in windows \d+-\d+ and \d+-\d+ \((n = \d+ cycles < \d+|drift/SE = \S+ > [-+0-9.Ee]+|sd log ratio = \S+ over tolerance)\)\.",
    "converged": r"All four coefficients below the steady floor at iteration \d+\.",
    "diverged": r"NaN / mass imbalance \S+ at iteration \d+\.",
}


def reason_fits(status: Column | str, reason: Column | str) -> Column:
    """Whether a stop reason reads as its status demands; false for other statuses and nulls."""
    out = F.lit(False)
    for name, pattern in STOP_REASONS.items():
        out = F.when(col(status) == name, col(reason).rlike(f"^(?:{pattern})$")).otherwise(out)
    return F.coalesce(out, F.lit(False))


def is_pair(values: Column | str) -> Column:
    """Whether an array holds two numbers in ascending order."""
    v = col(values)
    return F.coalesce((F.size(v) == 2) & (v[0] <= v[1]), F.lit(False))


def array_shape(values: Column | str) -> Column:
    """Length of an array, how many of its elements are null, and whether all elements are finite numbers."""
    v = col(values)
    bad = F.size(F.filter(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return F.struct(F.size(v).alias("length"), F.size(F.filter(v, lambda x: x.isNull())).alias("nulls"), ((bad == 0) & (F.size(v) > 0)).alias("numeric"))


def missing_keys(mapped: Column | str, wanted: list[str]) -> Column:
    """The wanted keys that a map lacks, in their order."""
    return F.array_except(F.array(*map(F.lit, wanted)), F.map_keys(col(mapped)))


def json_get(text: Column | str, path: str, kind: str, default: object = None) -> Column:
    """A typed value out of JSON text, or a default if it is missing or of another type."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(col(text)), path, kind), F.lit(default))


def utc_stamp(when: Column | str) -> Column:
    """A time as 2024-01-31T12:00:00Z, whatever the session's zone."""
    return F.date_format(F.to_utc_timestamp(col(when).cast("timestamp"), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def header_base(name: Column | str) -> Column:
    """A header cell without quotes and without its unit in () or []."""
    return F.trim(F.regexp_replace(F.regexp_replace(col(name), "^\\s*\"|\"\\s*$", ""), r"\s*[\(\[].*$", ""))


def non_negative_root(variance: Column | str) -> Column:
    """sqrt of a variance that round-off may have made negative."""
    return F.sqrt(F.greatest(col(variance), F.lit(0.0)))


def sweep_alias(prefix: str, value: Column | str, width: int = 4) -> Column:
    """Zero-padded, with p for the decimal point and e for a power of ten."""
    text = F.replace(F.replace(F.lower(col(value).cast("string")), F.lit("."), F.lit("p")), F.lit("e+"), F.lit("e"))
    return F.concat(F.lit(prefix), F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text))
