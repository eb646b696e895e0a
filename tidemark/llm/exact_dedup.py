"""Exact deduplication with a heavy-hitter split (DataFrame functions only).

Digests of the normalised texts go through a Misra-Gries summary (``approx_top_k``, a mergeable frequent-items sketch
of that family). Every digest that holds more than ``rows / tracked`` of the rows is in the summary, so the candidates
cover all groups that could swamp a task. Their exact size and winner are counted with map-side partial aggregation and
broadcast (at most ``heavy`` rows of constant width); their rows never move. All other digests, of at most one row in
``heavy`` each, take the ordinary shuffle: a grouped maximum, combined before it moves, and a join, which may be split
where a digest still has many rows. No task holds a group at once.

Cases: a null text counts as empty; a null ``doc_id`` loses against any other; of repeated rows (same id and text) one
is kept and the others are not, ties going to the first row in file order; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, stored

#: Heavy digests at most, and counters of the sketch. A digest beyond 1 / (0.75 * TRACKED) of all rows is always found.
HEAVY, TRACKED = 1024, 8192
#: Fewer copies than this are not worth a broadcast row.
LEAST_COPIES = 32


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the SHA-256 of the normalised text, and a row number that tells repeated rows apart. Written once."""
    normal = F.sha2(lower_ascii(F.coalesce(F.col(text), F.lit(""))).cast("binary"), 256)
    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.unhex(normal).alias("digest"))
    return stored(slim.withColumn("rid", F.monotonically_increasing_id()), "digests")


def heavy_digests(slim: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """At most ``heavy`` digests with their exact size and winner, as a small table."""
    top = slim.agg(F.expr(f"approx_top_k(hex(digest), {heavy}, {tracked})").alias("top"))
    likely = top.select(F.explode("top").alias("t")).select(F.unhex("t.item").alias("digest"), F.col("t.count").alias("about")).filter(F.col("about") >= LEAST_COPIES)
    exact = slim.join(F.broadcast(likely.select("digest")), "digest").groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct(F.col("doc_id"), (-F.col("rid")).alias("late"))).alias("best"))
    return stored(exact.select("digest", "group_size", F.col("best.doc_id").alias("keep_id"), (-F.col("best.late")).alias("keep_rid")), "heavy")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    slim = digests(docs, doc_id, text)
    winners = F.broadcast(heavy_digests(slim, heavy, tracked))
    split = slim.join(winners, "digest", "left")
    hot = split.filter(F.col("group_size").isNotNull()).select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "digest")
    cold = slim.join(winners, "digest", "left_anti")
    # nulls sort first, so the largest struct has the largest id that there is
    best = cold.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct(F.col("doc_id"), (-F.col("rid")).alias("late"))).alias("best"))
    rest = cold.join(best.hint("merge"), "digest")
    rest = rest.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("rid") == -F.col("best.late")).alias("kept"), "digest")
    return hot.unionByName(rest).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns. Ids must be unique here."""
    kept = exact_dedup(docs, doc_id, text).filter("kept").select(F.col("doc_id").alias("_keep")).hint("merge")  # grows with the input: never broadcast
    return docs.join(kept, docs[doc_id].eqNullSafe(kept["_keep"]), "left_semi")


ORACLE = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
h AS (SELECT doc_id, sha256(t) AS text_sha256 FROM n)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM h
"""
