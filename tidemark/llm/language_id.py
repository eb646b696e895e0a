"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are multiplied as odds: the text (naive Bayes over hashed character trigrams, learned from a
bounded sample of labelled documents), the language that the markup declares, the country suffix of the host, and a
prior of the host. Host priors are smoothed in a hierarchy: host over registered domain over suffix over all, each
level's mean counts of first-pass posteriors shrunk towards the level above. They come from grouped sums, so a host
with a third of all pages costs one row per task. A page's own first-pass posterior is taken out of its host's counts.

How much a declaration or a suffix says is counted too: joint sums of declared value and first-pass posterior.

Cases: null text or html counts as empty, null URLs have no host; evidence that is missing says nothing; a record
without any evidence gets the corpus-wide prior; ties go to the first language by name; repeated rows are judged each;
without labelled documents there are no languages and the result has null languages; empty tables give empty results;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import _TO_LOWER, chunks, join_keyed, stored, utf8_of

#: Hash buckets of trigrams; smoothing; labelled documents used at most; trigrams whose evidence counts in full.
BUCKETS, SMOOTH, FIT_ROWS, FULL = 1 << 15, 0.5, 4000, 50
#: Pseudo-counts with which a level of the hierarchy follows the one above.
SHRINK = 8.0
_TAG = re.compile(r"<[^<>]*+>|&[a-z#0-9]{2,8};")
_OPEN = re.compile(r"(?i)<(script|style)\b|<!--")
_CLOSE = {"script": re.compile(r"(?i)</script\s*>"), "style": re.compile(r"(?i)</style\s*>"), None: re.compile(r"-->")}


def visible(html: str) -> str:
    """What a reader of the page sees, roughly. Linear: after an opening without an end, none of its kind is looked for again."""
    out, at, unclosed = [], 0, set()
    for opening in _OPEN.finditer(html):
        kind = opening[1].lower() if opening[1] else None
        if opening.start() < at or kind in unclosed:
            continue
        end = _CLOSE[kind].search(html, opening.end())
        if end is None:
            unclosed.add(kind)
            continue
        out.append(html[at : opening.start()])
        at = end.end()
    return _TAG.sub(" ", " ".join([*out, html[at:]]))


def trigrams(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte trigrams that hold a letter, and the text of each."""
    data, off = utf8_of(texts)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = _TO_LOWER[data]
    low = np.where((low >= 97) & (low <= 122) | (low >= 128), low, 32).astype(np.uint64)
    value = low[:-2] << np.uint64(16) | low[1:-1] << np.uint64(8) | low[2:]
    doc = np.searchsorted(off, np.arange(len(value)), side="right") - 1
    keep = (np.arange(len(value)) + 3 <= off[doc + 1]) & (value != 0x202020)
    mixed = (value[keep] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    return (mixed % np.uint64(buckets)).astype(np.int64), doc[keep]


def model(counts: dict[str, np.ndarray], smooth: float = SMOOTH) -> tuple[list[str], np.ndarray]:
    """Languages by name and the log probability of each trigram bucket in each."""
    langs = sorted(counts)
    table = np.array([counts[lang] for lang in langs], float)
    return langs, np.log((table + smooth) / (table.sum(axis=1, keepdims=True) + smooth * table.shape[1])) if langs else table


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in chunks(batches):
            bucket, doc = trigrams(batch.column("text"), buckets)
            lang = np.array(batch.column("lang").to_pylist(), object)
            for name in set(lang):
                counts[name] = counts.get(name, 0) + np.bincount(bucket[(lang == name)[doc]], minlength=buckets)
        for name, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.record_batch([pa.array([name] * max(1, len(at))), pa.array(at if len(at) else [0]), pa.array(n[at] if len(at) else [0])], ["lang", "bucket", "n"])

    return run


def fit(docs: DataFrame, rows: int = FIT_ROWS, buckets: int = BUCKETS, smooth: float = SMOOTH) -> tuple[list[str], np.ndarray]:
    """The model of at most ``rows`` documents with a language, chosen by a hash of the id.

    Ids are chosen first, so that texts of no others move; the driver gets a row per language and bucket.
    """
    has = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = has.select(F.col("doc_id").alias("fit_id")).orderBy(F.xxhash64("fit_id"), "fit_id").limit(rows).distinct()
    chosen = has.join(F.broadcast(ids), F.col("doc_id").eqNullSafe(F.col("fit_id")), "left_semi").select("lang", "text")
    found = chosen.mapInArrow(_count(buckets), "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts: dict[str, np.ndarray] = {}
    lang = np.array(found.column("lang").to_pylist(), object)
    for name in sorted(set(lang)):
        mine = lang == name
        counts[name] = np.bincount(found.column("bucket").to_numpy()[mine], weights=found.column("n").to_numpy()[mine], minlength=buckets)
    return model(counts, smooth)


def _likelihoods(shared, markup: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table = shared.value
        for batch in chunks(batches, limit=2 << 20):
            texts = batch.column("text")
            if markup:
                texts = pa.array([visible(t) for t in texts.to_pylist()], pa.string())
            bucket, doc = trigrams(texts, table.shape[1])
            n = np.bincount(doc, minlength=batch.num_rows)
            # neighbouring trigrams overlap, so beyond FULL of them the evidence stops growing
            scale = np.minimum(n, FULL) / np.maximum(n, 1)
            logs = np.stack([np.bincount(doc, weights=row[bucket], minlength=batch.num_rows) for row in table], axis=1) * scale[:, None]
            values = pa.FixedSizeListArray.from_arrays(pa.array(logs.ravel()), len(langs)).cast(pa.list_(pa.float64()))
            yield batch.drop_columns(["text"]).append_column("logs", values)

    return run


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def declared_of(html: Column) -> Column:
    """The primary subtag of <html lang>."""
    tag = F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    return F.when(tag != "", tag)


def records(pages: DataFrame | None, docs: DataFrame | None) -> list[tuple[DataFrame, bool]]:
    """Pages and plain documents in one shape: doc_id, page_id, host, domain, suffix, declared, text."""
    out = []
    if pages is not None:
        host = host_of(F.col("url"))
        out.append((pages.select(F.lit(None).cast("bigint").alias("doc_id"), F.col("page_id").cast("bigint").alias("page_id"), host.alias("host"), declared_of(F.col("html")).alias("declared"), F.col("html").cast("string").alias("text")), True))
    if docs is not None:
        out.append((docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lit(None).cast("bigint").alias("page_id"), F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("declared"), F.col("text").cast("string").alias("text")), False))
    return out


def _normalised(logs: Column) -> Column:
    """Posteriors from log weights."""
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def _sums(rows: DataFrame, key: list[str], k: int, name: str) -> DataFrame:
    """Summed first-pass posteriors per key: one narrow row per key and task before the shuffle."""
    return rows.groupBy(*key).agg(F.array(*[F.sum(F.col("first")[i]) for i in range(k)]).alias(name))


def _with_priors(seen: DataFrame, hosts: DataFrame, rows: float) -> DataFrame:
    """Records with ``counts`` and ``domain_prior`` of their host; null without one.

    Hosts with a share of all records are few, so they are broadcast; records without a host don't take part.
    """
    none = seen.filter(F.col("host").isNull()).withColumn("counts", F.lit(None).cast("array<double>")).withColumn("domain_prior", F.lit(None).cast("array<double>"))
    sized = hosts.withColumn("records", F.aggregate("counts", F.lit(0.0), lambda a, x: a + x))  # posteriors sum to one
    return none.unionByName(join_keyed(seen.filter(F.col("host").isNotNull()), sized, "host", "records", rows, "left").select(*none.columns))


def identify(pages: DataFrame | None, docs: DataFrame, spark=None, judge_docs: bool = True, fit_rows: int = FIT_ROWS, shrink: float = SHRINK) -> DataFrame:
    """One row per page (and per document): doc_id, page_id, host, declared, lang, probability, text_lang."""
    spark = spark or docs.sparkSession
    langs, table = fit(docs, fit_rows)
    k = len(langs)
    parts = records(pages, docs if judge_docs else None)
    if not k:
        union = None
        for rows, _ in parts:
            one = rows.select("doc_id", "page_id", "host", "declared", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"), F.lit(None).cast("string").alias("text_lang"))
            union = one if union is None else union.unionByName(one)
        return union
    shared = spark.sparkContext.broadcast((langs, table))
    schema = "doc_id bigint, page_id bigint, host string, declared string, logs array<double>"
    union = None
    for rows, markup in parts:
        one = rows.mapInArrow(_likelihoods(shared, markup), schema)
        union = one if union is None else union.unionByName(one)
    labels = F.element_at(F.split("host", r"\."), -1)
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    seen = union.withColumn("first", _normalised(F.col("logs"))).withColumn("suffix", F.when(F.col("host").isNotNull(), labels)).withColumn("domain", F.when(F.col("host").isNotNull(), F.coalesce(F.nullif(domain, F.lit("")), F.col("host"))))
    seen = stored(seen, "evidence")

    ones = F.array(*[F.lit(1.0 / k)] * k)
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    scaled = lambda a, s: F.transform(a, lambda x: x * s)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    shrunk = lambda counts, up: F.transform(add(counts, scaled(up, F.lit(shrink))), lambda x: x / (total(counts) + F.lit(shrink)))

    # Levels of the hierarchy, from all records down to hosts.
    everything = _sums(seen, [], k, "all_counts").withColumn("all_counts", F.when(F.col("all_counts")[0].isNull(), F.array(*[F.lit(0.0)] * k)).otherwise(F.col("all_counts")))
    per_host = stored(_sums(seen.filter(F.col("host").isNotNull()), ["host", "domain", "suffix"], k, "counts"), "hosts")
    fold = lambda key, name: per_host.groupBy(key).agg(F.array(*[F.sum(F.col("counts")[i]) for i in range(k)]).alias(name))
    world = [r["all_counts"] for r in everything.collect()][0]
    world_prior = F.array(*[F.lit((c + shrink / k) / (sum(world) + shrink)) for c in world])
    suffixes = fold("suffix", "suffix_counts").withColumn("suffix_prior", shrunk(F.col("suffix_counts"), world_prior)).select("suffix", "suffix_prior")
    domains = per_host.groupBy("domain", "suffix").agg(F.array(*[F.sum(F.col("counts")[i]) for i in range(k)]).alias("domain_counts")).join(suffixes, "suffix").withColumn("domain_prior", shrunk(F.col("domain_counts"), F.col("suffix_prior"))).select("domain", "domain_prior")
    hosts = stored(per_host.join(domains, "domain").select("host", "counts", "domain_prior"), "host_priors")

    # What a declared language says: posterior-weighted counts per declared value.
    declared = _sums(seen.filter(F.col("declared").isNotNull()), ["declared"], k, "said")
    n_lang = [max(1e-9, c) for c in world]
    rate = F.transform(F.zip_with("said", F.array(*map(F.lit, n_lang)), lambda x, n: (x + 0.5) / (n + 1.0)), lambda x: F.log(x))
    declared = declared.select("declared", rate.alias("declared_logs"))

    joined = _with_priors(seen, hosts, sum(world))
    joined = joined.join(F.broadcast(declared.withColumnRenamed("declared", "said")), F.col("declared") == F.col("said"), "left").drop("said")  # subtags of 2 or 3 letters: at most 18,252 rows
    others = F.transform(F.zip_with("counts", "first", lambda c, f: c - f), lambda x: F.greatest(x, F.lit(0.0)))
    prior = F.when(F.col("counts").isNotNull(), shrunk(others, F.col("domain_prior"))).otherwise(world_prior)
    logs = F.zip_with("logs", F.transform(prior, lambda x: F.log(x + F.lit(1e-12))), lambda a, b: a + b)
    logs = F.when(F.col("declared_logs").isNotNull(), F.zip_with(logs, F.col("declared_logs"), lambda a, b: a + b)).otherwise(logs)
    names = F.array(*map(F.lit, langs))
    best = lambda a: F.element_at(names, F.array_position(a, F.array_max(a)).cast("int"))
    out = joined.withColumn("posterior", _normalised(logs))
    has_text = total(F.transform("logs", F.abs)) > 0
    return out.select("doc_id", "page_id", "host", "declared", best(F.col("posterior")).alias("lang"), F.array_max("posterior").alias("probability"), F.when(has_text, best(F.col("first"))).alias("text_lang"))
