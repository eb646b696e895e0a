"""How far the sources of a language are from each other, and by which terms.

Two passes over the texts. The first counts in how many documents of a language each term stands; terms of at least
``LEAST_DOCS`` documents are kept. The second finds their occurrences with an automaton (pyahocorasick): kept terms have a
space on either side, every delimiter of the texts becomes a space, and since neighbours share the space between them, all
occurrences of whole terms are found and no others. The automaton reads each distinct term of a chunk of texts once, and
what it finds holds wherever the term stands in the chunk. The counts of (language, source, term) are sparse postings: terms
that a source lacks have a share that depends on the source alone, so a pair's sum over all kept terms is a sum over the
terms that both have, over the distinct shares of either, and a product for those that neither has.

The vocabulary grows with the corpus, so it is never broadcast whole. Languages are packed into blocks of at most
``BLOCK_BYTES`` bytes, a larger one is dealt by hash to several blocks, and for each block the second pass reads the
texts of its languages alone. Terms of more than ``LONG`` bytes go by their digest, in
the automaton and in the texts, which bounds its size by the number of terms.

Cases: null text, lang or source count as ''; texts without terms and empty texts still make their (lang, source) occur;
a language without kept terms has pairs of value 0 and no terms; a source alone in its language has no pairs; repeated
rows are documents of their own; ties in value go by the bytes of the item; an empty table gives an empty result; other
columns are ignored. Sums are exact (decimals), and an excess over a long is an error.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import chunks, join_keyed, pieces, prepared, shared_dir, stored, utf8_of

LEAST_DOCS, TOP_TERMS = 3, 200
#: Bytes of the kept terms of a block (a node takes 40, and terms share their beginnings), and of a term that is not replaced by its digest.
BLOCK_BYTES, LONG = 5 << 20, 200
#: Counted terms that a task holds before it hands them on.
HELD = 300_000
#: Shares of the histograms of a language are dealt to so many parts.
PARTS = 32

#: ASCII letters stay or are lower-cased, bytes of other characters stay, all else becomes a space.
_TABLE = bytes(c if c >= 128 or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))
_BYTES = np.frombuffer(_TABLE, np.uint8)
_LONG = re.compile(rb"[^ ]{%d,}" % (LONG + 1))


def _mark(term: bytes) -> bytes:
    """What a long term is replaced by: no text holds the first character once its delimiters are spaces."""
    return b"\x01" + hashlib.md5(term).hexdigest().encode()


def _has_long(spaced: bytes) -> bool:
    """Whether a term has more than LONG bytes: looks for a space in every stretch of that length, not at every byte."""
    at, end = 0, len(spaced)
    while end - at > LONG:
        space = spaced.rfind(b" ", at, at + LONG + 1)
        if space < 0:
            return True
        at = space + 1
    return False


def _terms_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms of some texts, which one stands where, and in which text."""
    data, off = utf8_of(texts)
    data = _BYTES[data]
    inside = data != 32
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = off[:-1][off[:-1] < len(data)]
    first[begins] = inside[begins]  # a text's first byte never goes on with a term of the text before
    at = np.flatnonzero(first)
    bytes_of = data[inside]
    start = np.cumsum(inside, dtype=np.int32)[at] - 1
    coded = pieces(bytes_of, np.append(start, len(bytes_of)), pa.binary()).dictionary_encode()
    text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(at, off)))
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), text


def _codes(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    coded = column.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, term and the number of documents of some rows that hold it."""
    held: list[pa.Table] = []

    def merged() -> pa.Table:
        return pa.concat_tables(held).group_by(["lang", "term"]).aggregate([("docs", "sum")]).rename_columns(["lang", "term", "docs"])

    for batch in chunks(batches):
        terms, which, text = _terms_in(batch.column("text"))
        if not len(terms):
            continue
        langs, lang = _codes(batch.column("lang"))
        pair = np.sort(text * len(terms) + which)
        text, which = np.divmod(pair[np.concatenate([[True], pair[1:] != pair[:-1]])], len(terms))  # each term of a document once
        key, docs = np.unique(lang[text] * len(terms) + which, return_counts=True)
        lang, which = np.divmod(key, len(terms))
        held.append(pa.table([langs.take(pa.array(lang)), terms.take(pa.array(which)), pa.array(docs)], ["lang", "term", "docs"]))
        if sum(map(len, held)) > 2 * HELD:
            held[:] = [merged()]
            if len(held[0]) > HELD:
                yield from held.pop().cast(_TERMS).to_batches(max_chunksize=100_000)
    if held:
        yield from merged().cast(_TERMS).to_batches(max_chunksize=100_000)


_TERMS = pa.schema([("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64())])


def kept_terms(docs: DataFrame) -> DataFrame:
    """lang and term for the terms that stand in enough documents of the language; ``docs`` has lang and text."""
    counted = docs.select("lang", "text").mapInArrow(_document_counts, "lang string, term string, docs bigint")
    return counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= LEAST_DOCS).select("lang", "term")


class Vocabulary:
    """The kept terms of a block by language, numbered through, and their automata, made once per worker."""

    _made: dict[str, tuple[dict, pa.Array]] = {}

    def __init__(self, terms: dict[str, list[str]]):
        self.terms, self.name = terms, uuid.uuid4().hex

    def automata(self) -> tuple[dict[str, ahocorasick.Automaton], pa.Array]:
        """The automaton of each language, and all terms by number."""
        if self.name not in self._made:
            self._made.clear()
            made, at = {}, 0
            for lang, terms in self.terms.items():
                made[lang] = self._automaton(terms, at)
                at += len(terms)
            self._made[self.name] = made, pa.array([t for terms in self.terms.values() for t in terms], pa.string())
        return self._made[self.name]

    @staticmethod
    def _automaton(terms: list[str], at: int) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, term in enumerate(terms, at):
            raw = term.encode()
            out.add_word(f" {term if len(raw) <= LONG else _mark(raw).decode()} ", i)
        out.make_automaton()
        return out


def _numbers(automaton: ahocorasick.Automaton, terms: list[bytes]) -> np.ndarray:
    """The number of each term, -1 if it is not kept."""
    raw = b" " + b" ".join(terms) + b" "
    if _has_long(raw):
        raw = _LONG.sub(lambda m: _mark(m[0]), raw)
    line = raw.decode()
    spaces = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), np.uint32) == 32)
    hits = np.fromiter(chain.from_iterable(automaton.iter(line)), np.int64).reshape(-1, 2)  # the space behind a term, its number
    out = np.full(len(terms), -1, np.int64)
    out[np.searchsorted(spaces, hits[:, 0]) - 1] = hits[:, 1]
    return out


_FOUND = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("count", pa.int64())])


def _occurrences(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """lang, source, kept term and its occurrences in some rows."""
        automata, every = vocabulary.value.automata()
        groups: dict[tuple[str, str], int] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []  # group and term in one number, ascending, and occurrences

        def merge() -> None:
            keys, counts = (np.concatenate(part) for part in zip(*held, strict=True))
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            held[:] = [(keys[first], np.add.reduceat(counts[order], first))]

        def rows() -> Iterator[pa.RecordBatch]:
            ((keys, counts),) = held
            group, term = np.divmod(keys, len(every))
            lang, source = (pa.array([g[i] for g in groups], pa.string()).take(pa.array(group)) for i in (0, 1))
            yield from pa.table([lang, source, every.take(pa.array(term)), pa.array(counts)], schema=_FOUND).to_batches(max_chunksize=100_000)
            held.clear()
            groups.clear()

        for batch in chunks(batches):
            terms, which, text = _terms_in(batch.column("text"))
            langs, lang = _codes(batch.column("lang"))
            sources, source = _codes(batch.column("source"))
            langs, sources = langs.to_pylist(), sources.to_pylist()
            pairs, pair = np.unique(lang * len(sources) + source, return_inverse=True)
            named = [(langs[p // len(sources)], sources[p % len(sources)]) for p in pairs.tolist()]
            first = np.array([groups.setdefault(n, len(groups)) for n in named], np.int64)[pair].take(text) * len(every)  # of a term's group
            lang = lang.take(text)
            for i, name in enumerate(langs):
                here = np.flatnonzero(lang == i)
                if name not in automata or not len(here):
                    continue
                own = which.take(here)
                number = np.full(len(terms), -1, np.int64)
                number[own] = 0
                distinct = np.flatnonzero(number == 0)
                number[distinct] = _numbers(automata[name], terms.take(pa.array(distinct)).to_pylist())
                own = number.take(own)
                found = (first.take(here) + own)[own >= 0]
                if len(found):
                    held.append(np.unique(found, return_counts=True))
            if sum(len(k) for k, _ in held) > 2 * HELD:
                merge()
                if len(held[0][0]) > HELD:
                    yield from rows()
        if held:
            merge()
            yield from rows()

    return run


def blocks_of(kept: DataFrame) -> list[tuple[Column, Column]]:
    """Conditions on lang and term that deal kept terms to blocks, and on lang for the texts that each block needs.

    The driver sees the languages that hold more than a sixteenth of a block; all others are dealt by hash.
    """
    lang, term = F.col("lang"), F.col("term")
    weights = stored(kept.groupBy("lang").agg(F.sum(F.least(F.octet_length("term") + 2, F.lit(LONG + 2))).alias("weight")), "weights")
    large = weights.filter(F.col("weight") > BLOCK_BYTES / 16)
    out, packed, room = [], [], 0
    for name, weight in sorted(map(tuple, large.collect()), key=lambda r: (-r[1], r[0])):
        parts = -(-weight // BLOCK_BYTES)
        if parts > 1:
            out += [((lang == name) & (F.pmod(F.xxhash64(term), F.lit(parts)) == k), lang == name) for k in range(parts)]
        elif packed and weight <= room:
            packed[-1].append(name)
            room -= weight
        else:
            packed.append([name])
            room = BLOCK_BYTES - weight
    out += [(lang.isin(names), lang.isin(names)) for names in packed]
    rest = weights.filter(F.col("weight") <= BLOCK_BYTES / 16)
    bins = -(-2 * (rest.agg(F.sum("weight")).first()[0] or 0) // BLOCK_BYTES)
    if bins:
        known = [r[0] for r in large.select("lang").collect()]
        for k in range(bins):
            own = ~lang.isin(known) & (F.pmod(F.xxhash64(lang), F.lit(bins)) == k)
            out.append((own, own))
    return out


def postings(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, term, count (above 0) of the kept terms, written block by block."""
    spark = prepared(docs.sparkSession)
    path = shared_dir(spark, "postings")
    schema = "lang string, source string, term string, count bigint"
    spark.createDataFrame([], schema).write.parquet(path)
    for of_terms, of_texts in blocks_of(kept):
        terms: dict[str, list[str]] = {}
        for lang, term in kept.filter(of_terms).toLocalIterator():  # a block, so bounded
            terms.setdefault(lang, []).append(term)
        vocabulary = spark.sparkContext.broadcast(Vocabulary(terms))
        found = docs.filter(of_texts).select("lang", "source", "text").mapInArrow(_occurrences(vocabulary), schema)
        found.groupBy("lang", "source", "term").agg(F.sum("count").alias("count")).write.mode("append").parquet(path)
        vocabulary.unpersist()
    return spark.read.schema(schema).parquet(path)


def _share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (n + v)), exact for counts of any size; null where nothing is kept."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.when(v > 0, F.call_function("div", (wide(count) + 1) * F.lit(1_000_000_000).cast("decimal(10,0)"), wide(n) + wide(v)) + 1)


def _far(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most 10^9 + 1, so the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part (pair or term), item, value, rank: the distance to every other source of the language, and the terms that set the source apart from it."""
    filled = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    slim = docs.select(filled(lang, "lang"), filled(source, "source"), F.col(text).cast("string").alias("text"))
    kept = stored(kept_terms(slim), "vocabulary")
    found = postings(slim, kept)

    # One row per (lang, source): its total, the number of its terms, the kept terms of its language, the share of a term it lacks.
    group = F.struct("lang", "source")
    sizes = found.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("terms"))
    per_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    groups = slim.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(per_lang, "lang", "left").fillna(0, ["n", "terms", "v"])
    groups = stored(groups.withColumn("p0", _share(F.lit(0), F.col("n"), F.col("v"))), "groups")

    total = found.count()
    known = groups.filter("terms > 0").select(group.alias("g"), "n", "v", "p0", F.col("terms").alias("rows"))
    shares = join_keyed(found.withColumn("g", group), known, "g", "rows", total)
    shares = stored(shares.select("lang", "source", "term", "count", "p0", _share(F.col("count"), F.col("n"), F.col("v")).alias("p")), "shares")

    # Terms: against the share in the whole language.
    of_lang = groups.groupBy("lang").agg(F.sum("n").alias("n"), F.first("v").alias("v"), F.sum("terms").alias("rows"))
    by_term = shares.groupBy("lang", "term").agg(F.sum("count").alias("count"))
    overall = join_keyed(by_term, of_lang.filter("rows > 0"), "lang", "rows", total).select("lang", "term", _share(F.col("count"), F.col("n"), F.col("v")).alias("q"))
    ahead = shares.join(overall.hint("merge"), ["lang", "term"]).filter("p > q")
    ahead = ahead.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _far(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ahead = ahead.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP_TERMS)

    # Pairs: terms of both sources, with what the sums below count for them taken off again.
    a = shares.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("p0").alias("pa0"))
    b = shares.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("p0").alias("pb0"))
    c = {k: F.col(k) for k in ("pa", "pb", "pa0", "pb0")}
    more = _far(c["pa"], c["pb"]) - _far(c["pa"], c["pb0"]) - _far(c["pa0"], c["pb"]) + _far(c["pa0"], c["pb0"])
    exact = lambda col: F.sum(col.cast("decimal(28,0)"))
    both = a.join(b.hint("merge"), ["lang", "term"]).filter("a <> b").groupBy("lang", "a", "b").agg(exact(more).alias("part"))
    # Terms of one source against the share of a term that the other lacks: by distinct shares, of which there are few.
    part = F.pmod(F.xxhash64("source", "p"), F.lit(PARTS)).alias("part")
    bins = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("terms")).select("lang", part, F.col("source").alias("x"), "p", "terms")
    others = groups.filter("v > 0").select("lang", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(PARTS - 1).cast("bigint"))).alias("part"), F.col("source").alias("y"), F.col("p0").alias("y0"))
    p, y0 = F.col("p"), F.col("y0")
    times = lambda col: F.sum(col.cast("decimal(19,0)") * F.col("terms").cast("decimal(9,0)"))
    single = bins.join(others, ["lang", "part"]).filter("x <> y").groupBy("lang", "x", "y").agg(times(_far(p, y0)).alias("forth"), times(_far(y0, p)).alias("back"))
    single = stored(single, "single")
    forth = single.select("lang", F.col("x").alias("a"), F.col("y").alias("b"), F.col("forth").alias("part"))
    back = single.select("lang", F.col("y").alias("a"), F.col("x").alias("b"), F.col("back").alias("part"))
    # Terms that neither has.
    left, right = (groups.select("lang", F.col("source").alias(s), F.col("terms").alias(f"n{s}"), F.col("p0").alias(f"p{s}0"), "v") for s in "ab")
    rest = (F.col("v") - F.col("na") - F.col("nb")).cast("decimal(9,0)") * _far(c["pa0"], c["pb0"]).cast("decimal(19,0)")
    none = left.join(right.drop("v"), "lang").filter("a <> b").select("lang", "a", "b", F.coalesce(rest, F.lit(0)).alias("part"))
    wide = lambda df: df.select("lang", "a", "b", F.col("part").cast("decimal(38,0)").alias("part"))
    pairs = wide(both).unionByName(wide(forth)).unionByName(wide(back)).unionByName(wide(none)).groupBy("lang", "a", "b").agg(F.sum("part").cast("bigint").alias("value"))
    pairs = pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(ahead)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), o AS (SELECT id, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY ALL HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1) // (coalesce(t.total, 0) + v.v) AS p
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN t USING (lang, source) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), q AS (
  SELECT k.lang, k.term, 1 + CAST(1000000000 AS HUGEINT) * (sum(c.n) + 1) // (any_value(w.total) + any_value(v.v)) AS q
  FROM k JOIN v USING (lang) JOIN c USING (lang, term) JOIN (SELECT lang, sum(n) AS total FROM c GROUP BY lang) w USING (lang) GROUP BY ALL
), pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) f
    ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), r AS (
  SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value FROM pair
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, CAST((p.p - q.q) * (p.p - q.q) // q.q AS BIGINT) FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q
), ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""
