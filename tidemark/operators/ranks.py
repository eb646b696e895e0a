"""Exact order statistics of groups of any size, in bounded memory.

A group's wanted ranks are bracketed: a quantile sketch proposes two edges around each, rows are counted below, at,
between and above them, and the part that holds the rank is kept, until few rows are left in it or it is an edge. Only
then are rows numbered, at most ``FEW`` for a rank. No step sorts, shuffles or buffers a whole group: brackets of large
groups are few, so they are broadcast. Heavy tails or ties don't matter: edges are ranks, not distances.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a bracket that are numbered, quantiles that a sketch is asked for, and its accuracy: it errs by less than a cut.
FEW, CUTS, ACCURACY = 50_000, 256, 1000


def at_ranks(df: DataFrame, key: list[str], value: str, ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """key, and for every name the value at its rank, from 1 in ascending order. ``ranks``: from the rows of the group to a rank.

    Null and NaN values are no rows. A rank outside the group gives null.
    """
    slim = df.select(*key, F.col(value).alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan(F.col("_v").cast("double")))
    groups = slim.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).checkpoint()
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("_name"), r(F.col("_n")).cast("bigint").alias("_rank")) for name, r in ranks.items()])).alias("_w")
    # A bracket: values above _lo and below _hi (null: no bound), rows below it, rows in it.
    state = groups.select(*key, "_n", wanted).select(*key, "_n", "_w.*", F.col("_n").alias("_in"), F.lit(0).cast("bigint").alias("_below"))
    kind = slim.schema["_v"].dataType
    state = state.withColumns({"_lo": F.lit(None).cast(kind), "_hi": F.lit(None).cast(kind)}).checkpoint()
    names = [*key, "_name"]
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    other = lambda df: df.withColumnsRenamed({c: f"_k{i}" for i, c in enumerate(key)})
    equal = lambda rows, o: reduce(and_, [rows[c].eqNullSafe(o[f"_k{i}"]) for i, c in enumerate(key)])

    def inside(rows: DataFrame, brackets: DataFrame) -> DataFrame:
        b = other(brackets.drop("_n"))
        met = rows.join(b, equal(rows, b)) if key else rows.crossJoin(F.broadcast(b))  # without a key one row per rank
        return met.filter((lo.isNull() | (v > lo)) & (hi.isNull() | (v < hi))).drop(*[f"_k{i}" for i in range(len(key))])

    def numbered(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy(*names).orderBy("_v")
        return rows.withColumn("_i", F.row_number().over(order) + F.col("_below")).filter(F.col("_i") == F.col("_rank")).select(*names, "_v").checkpoint()

    # Groups of more than FEW rows are at most one in FEW rows of the table, so they are broadcast; the shuffle sees the others.
    large = other(groups.filter(F.col("_n") > FEW).select(*key))
    rest = slim.join(F.broadcast(large), equal(slim, large), "left_anti") if key else slim
    found = numbered(inside(rest, state.filter(F.col("_n") <= FEW)))
    state = state.filter(F.col("_n") > FEW)
    while not state.isEmpty():
        wide = state.filter(F.col("_in") > FEW)
        found = found.unionByName(numbered(inside(slim, F.broadcast(state.filter(F.col("_in") <= FEW)))))
        if wide.isEmpty():
            break
        sketch = inside(slim, F.broadcast(wide)).groupBy(*names).agg(F.percentile_approx("_v", [i / CUTS for i in range(1, CUTS)], ACCURACY).alias("_e"))
        sketch = other(sketch).withColumnRenamed("_name", "_kname")
        same = wide["_name"] == sketch["_kname"]
        at = F.floor((F.col("_rank") - F.col("_below")) / F.col("_in") * CUTS).cast("int")
        edged = wide.join(sketch, same & equal(wide, sketch) if key else same).select(*wide.columns, F.get("_e", at - 2).alias("_a"), F.get("_e", at + 1).alias("_b")).checkpoint()
        a, b = F.col("_a"), F.col("_b")
        part = F.when(v < a, 0).when(v == a, 1).when(b.isNull() | (v < b), 2).when(v == b, 3).otherwise(4)
        parts = inside(slim, F.broadcast(edged)).groupBy(*names, "_rank", "_below", "_lo", "_hi", "_a", "_b", part.alias("_part")).agg(F.count(F.lit(1)).alias("_in"))
        over = Window.partitionBy(*names).orderBy("_part")  # at most five rows
        parts = parts.withColumn("_through", F.sum("_in").over(over) + F.col("_below")).withColumn("_under", F.col("_through") - F.col("_in"))
        chosen = parts.filter((F.col("_through") >= F.col("_rank")) & (F.col("_under") < F.col("_rank"))).checkpoint()
        edge = F.col("_part").isin(1, 3)
        found = found.unionByName(chosen.filter(edge).select(*names, F.when(F.col("_part") == 1, a).otherwise(b).alias("_v")))
        low = F.when(F.col("_part") == 0, lo).when(F.col("_part") == 4, b).otherwise(F.coalesce(a, lo))
        high = F.when(F.col("_part") == 4, hi).when(F.col("_part") == 0, a).otherwise(F.coalesce(b, hi))
        state = chosen.filter(~edge).select(*key, F.col("_in").alias("_n"), "_name", "_rank", "_in", F.col("_under").alias("_below"), low.alias("_lo"), high.alias("_hi")).checkpoint()
    wide_ = found.groupBy(*key).agg(*[F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in ranks]).withColumnsRenamed({c: f"_k{i}" for i, c in enumerate(key)})
    on = [groups[c].eqNullSafe(wide_[f"_k{i}"]) for i, c in enumerate(key)]
    out = groups.join(wide_, on, "left") if on else groups.crossJoin(F.broadcast(wide_))  # one row
    return out.select(*key, *ranks)


def median(df: DataFrame, key: list[str], value: str, name: str = "median") -> DataFrame:
    """key and the median of its values: the mean of the two in the middle."""
    both = at_ranks(df, key, value, {"_low": lambda n: F.floor((n + 1) / 2), "_high": lambda n: F.floor(n / 2) + 1})
    return both.select(*key, ((F.col("_low") + F.col("_high")) / 2).alias(name))
