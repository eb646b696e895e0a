"""Near-duplicate embeddings by Euclidean p-stable hashing.

Vectors are normalised, projected on Gaussian directions, shifted and cut into steps of ``WIDTH``. ``PROJECTIONS`` such
numbers and the label make the key of a bucket, in each of ``TABLES`` tables. At a cosine of 0.98 (distance 0.2) two
vectors agree in one number with probability 0.90, in a key with 0.28, and in none of 32 keys in 2 of 100,000 cases; two
unrelated ones share a key in 2 of 100,000. In its buckets a vector first looks for partners by a sketch of 64 signs
(within ``SKETCH_BITS`` bits: 4 on average at 0.98, more than 16 in one of a million cases). Only vectors with a partner
send their components to that bucket, where cosines are computed in double precision. A pair that meets in several
tables counts in the first of them.

Only distinct vectors take part: copies cost nothing and count as links. No pairs are ever written: a bucket yields each
vector's number of links and a link of a spanning forest. A bucket of more than ``TILE`` vectors is dealt to pairs of
tiles, each a group of its own, so that none holds more than 2 * ``TILE`` vectors, however many the bucket has.

Cases: a null label, a vector that is null, empty or zero or has null or non-finite components links with nothing, not
even its copies; vectors of different length never link; null and repeated ids are rows like others (component_id is the
smallest id that is not null); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import groups_of, hooked, join_keyed, stored
from tidemark.llm.components import components

LEAST = 0.98
TABLES, PROJECTIONS, WIDTH = 32, 12, 1.6
SKETCH_BITS = 16
TILE = 4096
#: Rows of a bucket whose pairs with all others are looked at at once.
BLOCK = 512
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _STEP
    return x ^ (x >> np.uint64(32))


def directions(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of vectors of this length: projections and shifts of the tables, and normals of the sketch's planes."""
    rng = np.random.default_rng([42, size])
    return rng.standard_normal((size, TABLES * PROJECTIONS)), rng.uniform(0, WIDTH, TABLES * PROJECTIONS), rng.standard_normal((size, 64))


def keys_of(unit: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys (rows x tables) and sketches of unit vectors of one length."""
    project, shift, planes = directions(unit.shape[1])
    steps = np.floor((unit @ project + shift) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(unit), TABLES, PROJECTIONS)
    key = _mixed(np.arange(TABLES, dtype=np.uint64)[None, :] + _mixed(label.astype(np.int64).view(np.uint64) + np.uint64(unit.shape[1] << 32))[:, None])
    for k in range(PROJECTIONS):
        key = _mixed(key * _STEP + steps[:, :, k])
    return key.view(np.int64), np.packbits(unit @ planes > 0, axis=1, bitorder="little").view("<i8")[:, 0]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 2048):
            batch = whole.slice(at, 2048)
            size = batch.column("size").to_numpy()
            flat = batch.column("vector").flatten().to_numpy().astype(np.float64)
            start = np.concatenate([[0], np.cumsum(size)])
            keys, sketch = np.zeros((batch.num_rows, TABLES), np.int64), np.zeros(batch.num_rows, np.int64)
            for n in np.unique(size).tolist():
                rows = np.flatnonzero(size == n)
                v = flat[start[rows][:, None] + np.arange(n)]
                v = v / np.abs(v).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
                v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
                keys[rows], sketch[rows] = keys_of(v, batch.column("label").to_numpy()[rows])
            listed = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * TABLES), pa.array(keys.reshape(-1)))
            yield pa.record_batch([*(batch.column(c) for c in ("node", "copies", "first", "vector")), listed, pa.array(sketch)], ["node", "copies", "first", "vector", "keys", "sketch"])


def _near(sketch: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.bitwise_count(sketch[rows][:, None] ^ sketch[None, :]) <= SKETCH_BITS


def _with_partner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each bucket that have a partner by sketch."""
    for group in groups_of(batches, ["key"]):
        sketch = group.column("sketch").to_numpy().view(np.uint64)
        if len(sketch) > 1:
            parts = (np.arange(at, min(at + BLOCK, len(sketch))) for at in range(0, len(sketch), BLOCK))
            found = np.concatenate([_near(sketch, rows).sum(axis=1) > 1 for rows in parts])
            if found.any():
                yield group.select(["key", "left", "right", "node", "tile"]).filter(pa.array(found))


def _linked(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each group: node, root (a node of the group that links lead to) and links found here first, copies counted."""
        for group in groups_of(batches, ["key", "left", "right"]):
            n = group.num_rows
            if n < 2:
                continue
            v = group.column("vector").flatten().to_numpy().reshape(n, -1).astype(np.float64)
            v /= np.abs(v).max(axis=1, keepdims=True)
            v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
            sketch, node, copies, tile = (group.column(c).to_numpy() for c in ("sketch", "node", "copies", "tile"))
            sketch = sketch.view(np.uint64)
            keys = group.column("keys").flatten().to_numpy().reshape(n, TABLES)
            earlier = keys == group.column("key")[0].as_py()
            own = int(earlier[0].argmax())  # the table of this bucket; earlier ones count first
            # Within a tile, pairs are counted once: in the group of the tile with itself.
            apart = group.column("left")[0].as_py() != group.column("right")[0].as_py()
            links, root = np.zeros(n, np.int64), np.arange(n)
            for at in range(0, n, BLOCK):
                rows = np.arange(at, min(at + BLOCK, n))
                hit = _near(sketch, rows) & (v[rows] @ v.T >= least)
                hit[rows - at, rows] = False
                if apart:
                    hit &= tile[rows][:, None] != tile[None, :]
                i, j = np.nonzero(hit)
                i += at
                root = hooked(root, i, j)
                first = np.ones(len(i), bool)
                for t in range(own):
                    first &= keys[i, t] != keys[j, t]
                links += np.bincount(i[first], weights=copies[j[first]], minlength=n).astype(np.int64)
            some = (links > 0) | (root != np.arange(n)) | np.isin(np.arange(n), root[root != np.arange(n)])
            yield pa.record_batch([pa.array(node[some]), pa.array(node[root[some]]), pa.array(links[some])], ["node", "root", "links"])

    return run


def embedding_groups(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", least: float = LEAST) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors linked directly), component_id, kept (vec_id = component_id).

    The node of a distinct vector is the 64-bit hash of its label and components.
    """
    kind = "array<float>" if vectors.schema[embedding].dataType.simpleString() == "array<float>" else "array<double>"
    body = F.col(embedding).cast(kind)
    slim = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), body.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0)
    # -0.0 and 0.0 are equal numbers, so they must hash alike.
    slim = slim.withColumn("node", F.when(usable, F.xxhash64("label", F.transform("vector", lambda x: x + x * 0))))
    rows = stored(slim.select("vec_id", "node"), "vectors")
    apart = slim.filter("node IS NOT NULL").groupBy("node").agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    hashed = apart.select("node", "copies", "first", "vector", "label", F.size("vector").alias("size"))
    classes = stored(hashed.mapInArrow(_hashed, "node bigint, copies bigint, first bigint, vector " + kind + ", keys array<bigint>, sketch bigint"), "classes")

    places = classes.select(F.explode("keys").alias("key"), "node", "sketch")
    sizes = stored(places.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").withColumn("rows", F.col("members")), "buckets")
    shared = join_keyed(places, sizes, "key", "rows", classes.count() * TABLES)
    # Tiles of large buckets: a row goes to the group of its tile with every tile; small buckets are one tile.
    tiles = F.when(F.col("members") > TILE, F.ceil(F.col("members") / TILE)).otherwise(1).cast("int")
    tiled = shared.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("node", "key"), F.col("tiles")).cast("int"))
    one = F.lit(0).cast("int")
    small = tiled.filter("tiles = 1").select("key", "node", "sketch", one.alias("left"), one.alias("right"), "tile")
    small = small.repartition("key").sortWithinPartitions("key").mapInArrow(_with_partner, "key bigint, left int, right int, node bigint, tile int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    large = tiled.filter("tiles > 1").select("key", "node", "tile", other).select("key", F.least("tile", "other").alias("left"), F.greatest("tile", "other").alias("right"), "node", "tile")
    met = small.unionByName(large).join(classes.select("node", "copies", "vector", "keys", "sketch").hint("merge"), "node")
    met = met.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right")
    linked = stored(met.mapInArrow(_linked(least), "node bigint, root bigint, links bigint"), "linked")

    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    rooted = components(linked.filter("node <> root").select("node", "root"), "node", "root")
    nodes = classes.select("node", "copies", "first").join(links.hint("merge"), "node", "left").join(rooted.hint("merge"), "node", "left")
    nodes = stored(nodes.select("node", "copies", "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")), "nodes")
    least_id = nodes.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("members"))
    settled = stored(join_keyed(nodes, least_id, "root", "members", nodes.count()), "settled").select("node", "n_links", "component_id", "copies")
    out = join_keyed(rows.filter("node IS NOT NULL"), settled, "node", "copies", rows.count()).select("vec_id", "n_links", "component_id")
    alone = rows.filter("node IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


#: Brute force over the pairs of a label; no hashing.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (SELECT vec_id AS u, vec_id AS w FROM v UNION SELECT reach.u, l.w FROM reach JOIN l ON reach.w = l.u)
SELECT d.vec_id, coalesce((SELECT count(*) FROM l WHERE l.u = d.vec_id), 0) AS n_links, coalesce(c.component_id, d.vec_id) AS component_id, coalesce(c.component_id, d.vec_id) = d.vec_id AS kept
FROM embeddings d LEFT JOIN (SELECT u, min(w) AS component_id FROM reach GROUP BY u) c ON c.u = d.vec_id
"""
