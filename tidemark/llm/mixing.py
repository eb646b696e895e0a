"""Mixing sources to target weights with hash-threshold histograms.

Every document gets a uniform 60-bit hash of its id. Words are summed by source and hash bucket; the running sum shows
in which bucket a source's word budget ends; only that boundary bucket is split further, level by level, until it holds
one hash value. A document is then taken again if its hash lies below its source's threshold: a filter, no sort of the
documents. Thresholds of larger budgets contain those of smaller ones, so mixes are nested.

Cases: a null text has size 0; null is a source of its own, ordered last; a null id hashes as the empty string;
repeated rows share a hash and are taken together; sources without words get target 0; an empty table gives an empty
result; other columns are ignored here and passed through by :func:`mixed`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, fresh, stored

#: Weights of the sources in order, repeating; most passes over a source; bits of the hash, and bits split per level.
WEIGHTS, MOST, BITS, STEP = (1, 2, 3), 3, 60, 12
#: A table of one narrow row per source is broadcast up to this many rows, and joined by shuffling beyond it.
BROADCAST_SOURCES = 100_000


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size (words) and hash of each document, written once."""
    size = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("bigint")
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    hashed = F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("bigint")
    return stored(docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(source).alias("source"), size.alias("size"), hashed.alias("hash")), "sizes")


def targets(slim: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target, passes (whole takes) and budget (words of the last, partial take).

    Shares are capped at ``most`` times the source. Resharing the excess by weight until no source is above its cap ends
    at min(cap, level * weight), where the capped sources are those with the smallest cap per weight; so one running sum
    over the sources gives it.
    """
    per = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    cap = F.col("source_size") * most
    ranked = per.withColumn("w", w.cast("bigint")).withColumn("cap", cap)
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(onward)
    found = ranked.withColumn("level_here", level).withColumn("open", F.col("cap") >= F.col("level_here") * F.col("w"))
    found = found.withColumn("level", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("w"), F.col("level_here").alias("v")))).over(all_rows)["v"])
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("w"))
    out = found.withColumn("target", F.coalesce(target, F.col("cap").cast("double")))
    passes = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0)
    out = out.withColumn("passes", passes.cast("bigint"))
    return out.select("source", "source_size", "target", "passes", (F.col("target") - F.col("passes") * F.col("source_size")).alias("budget"))


def _with_sources(left: DataFrame, per_source: DataFrame, how: str = "inner") -> DataFrame:
    """Join on source, nulls included. The hot source does not matter: the small side is broadcast while its size allows it."""
    key = per_source.withColumnRenamed("source", "_source")
    small = per_source.count() <= BROADCAST_SOURCES
    return left.join(F.broadcast(key) if small else key, left["source"].eqNullSafe(key["_source"]), how).drop("_source")


def _level(rows: DataFrame, shift: int) -> DataFrame:
    """For each source the bucket of this level in which its budget ends, the words below that bucket, and whether it still holds several hashes."""
    bucket = F.shiftright("hash", shift)
    hist = rows.groupBy("source", "below", "budget", bucket.alias("bucket")).agg(F.sum("size").alias("words"), F.min("hash").alias("lo"), F.max("hash").alias("hi"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) + F.col("below")
    hist = hist.withColumn("upto", upto)
    edge = hist.filter((F.col("upto") > F.col("budget")) & (F.col("words") > 0))
    return edge.groupBy("source").agg(F.min(F.struct("bucket", "upto", "words", "budget", "lo", "hi")).alias("e")).select("source", F.col("e.bucket").alias("bucket"), (F.col("e.upto") - F.col("e.words")).alias("below"), F.col("e.words").alias("words"), F.col("e.budget").alias("budget"), F.col("e.lo").alias("lo"), F.col("e.hi").alias("hi"))


def thresholds(slim: DataFrame, goals: DataFrame) -> DataFrame:
    """source and the largest hash that is taken once more (null: all or none, as ``budget`` says)."""
    open_goals = goals.filter(F.col("budget") > 0).select("source", "budget")
    rows = _with_sources(slim, open_goals).withColumn("below", F.lit(0).cast("bigint"))
    done: DataFrame | None = None
    for shift in range(BITS - STEP, -1, -STEP):
        edge = stored(_level(rows, shift), f"edge{shift}")
        single = F.col("lo") == F.col("hi")
        # One hash is left: take it if that comes nearer to the budget.
        take = F.col("below") + F.col("words") - F.col("budget") < F.col("budget") - F.col("below")
        ended = edge.filter(single).select("source", F.when(take, F.col("hi")).otherwise(F.col("lo") - 1).alias("threshold"))
        done = ended if done is None else done.unionByName(ended)
        left = edge.filter(~single)
        if left.isEmpty():
            break
        inside = left.select("source", F.col("bucket").alias("_bucket"), F.col("below"), F.col("budget"))
        rows = _with_sources(slim, inside).filter(F.shiftright("hash", shift) == F.col("_bucket")).drop("_bucket")
    return done


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted), source, times."""
    slim = sizes(docs, doc_id, text, source)
    goals = stored(targets(slim, weights, most), "goals")
    plan = goals.join(thresholds(slim, goals).withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    extra: Column = F.when(F.col("threshold").isNotNull(), F.col("hash") <= F.col("threshold")).otherwise(F.col("budget") > 0)
    times = F.least(F.col("passes") + extra.cast("bigint"), F.lit(most))
    joined = _with_sources(slim, stored(plan, "plan"), "left").withColumn("times", times)
    return joined.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"), "source", "times")


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken. Documents without words are left out."""
    # The hash decides, so the thresholds apply to the rows themselves and no join on document ids is needed.
    slim = sizes(docs, doc_id, text, source)
    goals = stored(targets(slim), "goals")
    plan = goals.join(thresholds(slim, goals).withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").select("source", "passes", "threshold", "budget")
    plan = stored(plan, "plan")
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    hashed = F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("bigint")
    key, goal, copy = fresh(docs.columns, "mix_source", "mix_goal", "mix_copy")
    packed = plan.select(F.col("source").alias(key), F.struct("passes", "threshold", "budget").alias(goal))
    at = lambda c: F.col(goal)[c]
    extra = F.when(at("threshold").isNotNull(), hashed <= at("threshold")).otherwise(at("budget") > 0)
    times = F.least(at("passes") + extra.cast("bigint"), F.lit(MOST)).cast("int")
    side = F.broadcast(packed) if packed.count() <= BROADCAST_SOURCES else packed
    out = docs.join(side, docs[source].eqNullSafe(side[key]), "inner").filter(F.coalesce(F.col(text), F.lit("")).rlike(WORD))
    return out.withColumn(copy, F.explode(F.array_repeat(F.lit(1), times))).select(*[docs[c] for c in docs.columns])


ORACLE = """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash
  FROM documents),
p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, 3 * source_size AS cap, 1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS w FROM p),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS here FROM w),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), w * arg_min(here, cap / w) FILTER (WHERE cap >= here * w) OVER ()) AS target FROM l),
g AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS passes FROM t),
r AS (SELECT d.doc_id, d.size, d.hash, g.source, g.source_size, g.target, g.passes, g.target - g.passes * g.source_size AS budget,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.hash RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
             sum(d.size) OVER (PARTITION BY d.source, d.hash) AS here
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CAST(size * (passes + CASE WHEN budget > 0 AND (upto <= budget OR upto - here < budget AND upto - budget < budget - (upto - here)) THEN 1 ELSE 0 END) AS BIGINT) AS taken,
       source, CAST(passes + CASE WHEN budget > 0 AND (upto <= budget OR upto - here < budget AND upto - budget < budget - (upto - here)) THEN 1 ELSE 0 END AS BIGINT) AS times
FROM r
"""
