"""Allow-lists, set comparisons, balances and alignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def classify_objects(objects: DataFrame, name: str, owned: list[str], inherited: list[str], system: list[str], used: Column) -> DataFrame:
    """class of each object, the first that fits: owned, inherited, inherited_unused, system, unlisted (used but on no list), unknown. Lists hold patterns (rlike)."""
    on = lambda patterns: F.lit(False) if not patterns else F.col(name).rlike("|".join(f"(?:{p})" for p in patterns))
    said = F.when(on(owned), "owned").when(on(inherited) & used, "inherited").when(on(inherited), "inherited_unused").when(on(system), "system").when(used, "unlisted").otherwise("unknown")
    return objects.withColumn("class", said)


def object_counts(objects: DataFrame, key: list[str]) -> DataFrame:
    """Objects per class, and whether none of the key is unlisted or unknown."""
    bad = F.col("class").isin("unlisted", "unknown")
    per = objects.groupBy(*key, "class").agg(F.count(F.lit(1)).alias("n"))
    verdict = objects.groupBy(*key).agg((~F.bool_or(bad)).alias("passed"))
    return per.join(verdict, key) if key else per.crossJoin(verdict)


def missing_owned(objects: DataFrame, name: str, owned: DataFrame, owned_name: str) -> DataFrame:
    """Names on the closed list that no object has."""
    return owned.join(objects.select(F.col(name).alias("_n")), F.col(owned_name) == F.col("_n"), "left_anti")


def undeclared(present: DataFrame, path: str, patterns: list[str]) -> DataFrame:
    """Rows that fit none of the allowed patterns."""
    return present.filter(~F.col(path).rlike("|".join(f"(?:{p})" for p in patterns)))


def base_lookup(rows: DataFrame, key: str, base: str, value: str) -> DataFrame:
    """Each row with the value of the row its base names (null if there is none)."""
    side = rows.select(F.col(key).alias("_k"), F.col(value).alias("base_value"))
    return rows.join(side, F.col(base) == F.col("_k"), "left").drop("_k")


def base_climb(rows: DataFrame, known: DataFrame, start: str, base: str, place: str) -> DataFrame:
    """Where a relative base path is found, looked up from ``start`` and each folder above it, the nearest first.

    ``known``: the places there are (column ``place``). Adds ``found`` (null if nowhere) and ``climbed`` (folders up).
    """
    parts = F.filter(F.split(F.col(start), "/"), lambda p: p != "")
    tries = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda up: F.struct(up.alias("climbed"), F.array_join(F.concat(F.slice(parts, F.lit(1), F.size(parts) - up), F.split(F.col(base), "/")), "/").alias("at")))
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    hits = numbered.select("_row", F.explode(tries).alias("t")).select("_row", "t.*").join(known.select(F.col(place).alias("at")).distinct(), "at", "left_semi")
    best = hits.groupBy("_row").agg(F.min(F.struct("climbed", "at")).alias("b")).select("_row", F.col("b.at").alias("found"), F.col("b.climbed").alias("climbed"))
    return numbered.join(best, "_row", "left").drop("_row")


def elapsed_delta(marks: DataFrame, key: list[str], when: str, counters: list[str]) -> DataFrame:
    """How far counters (wall, CPU, physical time) went from the first to the last mark of a run."""
    return marks.groupBy(*key).agg(*[(F.max_by(c, when) - F.min_by(c, when)).alias(c) for c in counters])


def time_align(left: DataFrame, right: DataFrame, time: str, digits: int, key: list[str] | None = None) -> DataFrame:
    """Rows of both sides with the same rounded time; the right side's columns are prefixed with r_."""
    key = key or []
    r = right.select(*[F.col(k) for k in key], F.round(time, digits).alias("_t"), *[F.col(c).alias(f"r_{c}") for c in right.columns if c not in key])
    return left.withColumn("_t", F.round(time, digits)).join(r, [*key, "_t"]).drop("_t")


def two_route_check(a: DataFrame, b: DataFrame, value: str) -> DataFrame:
    """One row: the same scalar by two routes and their relative difference."""
    both = a.select(F.col(value).alias("route_a")).crossJoin(b.select(F.col(value).alias("route_b")))  # one row each
    return both.withColumn("difference", F.abs(F.col("route_a") - F.col("route_b")) / F.greatest(F.abs("route_a"), F.abs("route_b"), F.lit(1e-30)))


def mass_balance(df: DataFrame, key: list[str], flow: str) -> DataFrame:
    """Net of signed flows over the inflow (null without inflow)."""
    inflow = F.sum(F.greatest(F.col(flow), F.lit(0.0)))
    return df.groupBy(*key).agg(F.sum(flow).alias("net"), inflow.alias("inflow"), F.try_divide(F.sum(flow), inflow).alias("imbalance"))


def threshold_counts(df: DataFrame, key: list[str], value: str, thresholds: list[float]) -> DataFrame:
    """How many rows reach each threshold, one row per key and threshold."""
    counts = [F.struct(F.lit(float(t)).alias("threshold"), F.count_if(F.col(value) >= t).alias("n")) for t in thresholds]
    return df.groupBy(*key).agg(F.array(*counts).alias("_c")).select(*key, F.inline("_c"))


def key_sets(df: DataFrame, group: str, member: str, sides: tuple[str, str]) -> DataFrame:
    """Members that only one of two groups has, and those of both, as three sorted arrays."""
    sets = [F.collect_set(F.when(F.col(group) == s, F.col(member))) for s in sides]
    per = df.filter(F.col(group).isin(*sides)).agg(sets[0].alias("_a"), sets[1].alias("_b"))
    return per.select(F.array_sort(F.array_except("_a", "_b")).alias("only_first"), F.array_sort(F.array_except("_b", "_a")).alias("only_second"), F.array_sort(F.array_intersect("_a", "_b")).alias("both"))


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def first_messages(df: DataFrame, key: list[str], message: str, most: int = 4) -> DataFrame:
    """The first few messages of a key in order, and how many more there are. Only the smallest ``most`` are kept while aggregating."""
    from pyspark.sql import Window

    order = Window.partitionBy(*key).orderBy(message)
    few = df.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= most).groupBy(*key).agg(F.array_sort(F.collect_list(message)).alias("_m"))
    n = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    more = F.when(F.col("_n") > most, F.concat(F.lit(" (+"), (F.col("_n") - most).cast("string"), F.lit(" more)"))).otherwise("")
    return few.join(n, key).select(*key, F.concat(F.array_join("_m", "; "), more).alias("message"))


def contract_equal(a: DataFrame, b: DataFrame, key: list[str], contract: str) -> DataFrame:
    """Whether two JSON contracts are the same value (order of keys and spelling of numbers aside)."""
    x, y = a.select(*key, F.to_json(F.try_parse_json(contract)).alias("_a")), b.select(*key, F.to_json(F.try_parse_json(contract)).alias("_b"))
    return x.join(y, key, "full").select(*key, F.coalesce(F.col("_a") == F.col("_b"), F.lit(False)).alias("equal"))


def corners_masked(frames: DataFrame, mask: tuple[int, int, int], tolerance: int = 2) -> DataFrame:
    """Whether both top corners of a picture (columns width, pixels as r, g, b in turn) have the mask colour."""
    near = lambda at: F.forall(F.array(*[F.abs(F.get("pixels", at + k) - m) <= tolerance for k, m in enumerate(mask)]), lambda x: x)
    return frames.withColumn("masked", near(F.lit(0)) & near((F.col("width") - 1) * 3))
