"""Further queries on the standard tables, each with its DuckDB counterpart: small operators, units of text and keys, artifact checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.bindings import query, rounded, table
from tidemark.functions import expr
from tidemark.operators import accounts, diff, features, lattice, ledger, modal, neighbours, rules, sample, signals, text, windows
from tidemark.session import shared_base, stored
from tidemark.sources import readers

# --- columns and keys ------------------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity <> 0 THEN l_extendedprice / l_quantity END AS price, CASE WHEN l_quantity <> 0 THEN l_tax / l_quantity END AS tax FROM lineitem")
def scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").alias("price"), F.col("l_tax").alias("tax"), "l_quantity")
    return signals.scale(li, ["price", "tax"], F.col("l_quantity")).drop("l_quantity")


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity * l_discount * l_tax * l_tax <> 0 THEN l_extendedprice / (l_quantity * l_discount * l_tax * l_tax) END AS flux FROM lineitem")
def over_flux(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", expr.over_flux("l_extendedprice", "l_quantity", "l_discount", "l_tax").alias("flux"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_discount BETWEEN 0.02 AND 0.06")
def range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.within(table(spark, sf_dir, "lineitem"), l_quantity=(10, 20), l_discount=(0.02, 0.06)).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT s_suppkey, CASE WHEN s_acctbal > 500 THEN 1 WHEN s_acctbal < -500 THEN -1 ELSE 0 END AS side FROM supplier")
def side_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", neighbours.side_of(F.col("s_acctbal"), 500).alias("side"))


@query("""WITH b AS (SELECT c_nationkey AS k, sum(CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0 END) AS p, sum(CASE WHEN c_acctbal < 0 THEN -c_acctbal ELSE 0 END) AS n, count(*) FILTER (WHERE c_acctbal > 0) AS np, count(*) FILTER (WHERE c_acctbal < 0) AS nn FROM customer GROUP BY 1)
SELECT sum(np)::BIGINT AS n_positive, sum(nn)::BIGINT AS n_negative, round(sum(p), 2) + 0.0 AS sum_positive, round(sum(n), 2) + 0.0 AS sum_negative, round(abs(sum(p) - sum(n)) / greatest(sum(p), sum(n), 1e-30), 6) + 0.0 AS imbalance,
max(struct_pack(i := round(abs(p - n) / greatest(p, n, 1e-30), 9), k := k)).k AS worst, round(max(abs(p - n) / greatest(p, n, 1e-30)), 6) + 0.0 AS worst_imbalance FROM b""")
def worst_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").withColumn("v", F.abs("c_acctbal"))
    b = neighbours.side_balance(c, ["c_nationkey"], F.col("c_acctbal"), "v").withColumn("imbalance", rounded("imbalance", 9))
    w = neighbours.worst_balance(b, "c_nationkey")
    return w.select("n_positive", "n_negative", rounded("sum_positive", 2).alias("sum_positive"), rounded("sum_negative", 2).alias("sum_negative"), rounded("imbalance").alias("imbalance"), "worst", rounded("worst_imbalance").alias("worst_imbalance"))


@query("""WITH a AS (SELECT o_orderkey, (o_totalprice % 360) - 180 AS a FROM orders), d AS (SELECT o_orderkey, f, k, abs(a - f - 180 * floor((a - f + 90) / 180)) AS away FROM a, (SELECT unnest([0.0, 30.0, 60.0, 90.0, 120.0, 150.0])::DOUBLE AS f, unnest([0, 1, 2, 3, 4, 5]) AS k))
SELECT o_orderkey, arg_min(f, struct_pack(x := CASE WHEN away > 90 THEN 180 - away ELSE away END, k := k)) AS face FROM d GROUP BY 1""")
def nearest_face(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", expr.nearest_face((F.col("o_totalprice") % 360) - 180, [0, 30, 60, 90, 120, 150]).alias("face"))


@query("""WITH s AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'converged' WHEN 1 THEN 'diverged' WHEN 2 THEN 'stationary' ELSE 'other' END AS status,
CASE WHEN o_custkey % 2 = 0 THEN 'All four coefficients below the steady floor at iteration ' || o_custkey || '.' ELSE 'NaN / mass imbalance ' || o_totalprice || ' at iteration ' || o_custkey || '.' END AS reason FROM orders)
SELECT o_orderkey, CASE status WHEN 'converged' THEN regexp_full_match(reason, 'All four coefficients below the steady floor at iteration \\d+\\.') WHEN 'diverged' THEN regexp_full_match(reason, 'NaN / mass imbalance \\S+ at iteration \\d+\\.') ELSE false END AS fits FROM s""")
def stop_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderkey") % 4 == 0, "converged").when(F.col("o_orderkey") % 4 == 1, "diverged").when(F.col("o_orderkey") % 4 == 2, "stationary").otherwise("other")
    n = F.col("o_custkey").cast("string")
    reason = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("All four coefficients below the steady floor at iteration "), n, F.lit("."))).otherwise(F.concat(F.lit("NaN / mass imbalance "), F.col("o_totalprice").cast("string"), F.lit(" at iteration "), n, F.lit(".")))
    return table(spark, sf_dir, "orders").select("o_orderkey", expr.reason_fits(status, reason).alias("fits"))


@query("""WITH e AS (SELECT vec_id, list_concat(list_slice(CAST(embedding AS DOUBLE[]), 1, vec_id % 5), CASE vec_id % 3 WHEN 0 THEN [NULL] ELSE [] END, CASE vec_id % 7 WHEN 1 THEN ['nan'::DOUBLE] ELSE [] END) AS v FROM embeddings)
SELECT vec_id, len(v)::BIGINT AS length, len(list_filter(v, lambda x: x IS NULL))::BIGINT AS nulls, len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AS is_numeric FROM e""")
def array_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts of the vectors, some of them empty, some with a null or NaN behind."""
    none = F.array().cast("array<double>")
    more = [F.when(F.col("vec_id") % k == r, F.array(F.lit(x).cast("double"))).otherwise(none) for k, r, x in ((3, 0, None), (7, 1, float("nan")))]
    v = F.concat(F.slice(F.col("embedding").cast("array<double>"), F.lit(1), (F.col("vec_id") % 5).cast("int")), *more)
    s = table(spark, sf_dir, "embeddings").select("vec_id", expr.array_shape(v).alias("s"))
    return s.select("vec_id", F.col("s.length").cast("bigint").alias("length"), F.col("s.nulls").cast("bigint").alias("nulls"), F.col("s.numeric").alias("is_numeric"))


@query("""WITH e AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN replace(props, '"k"', '"z"') WHEN 1 THEN replace(props, '"k"', '"z": 0, "k"') WHEN 2 THEN '{' ELSE props END AS p FROM events)
SELECT event_id, list_aggregate(list_filter(['k', 'z'], lambda x: NOT list_contains(coalesce(json_keys(CASE WHEN json_valid(p) THEN p END), []), x)), 'string_agg', ',') AS missing FROM e""")
def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties with the one key, the other, both, and text that is no JSON."""
    k, key = F.col("event_id") % 4, F.lit('"k"')
    p = F.when(k == 0, F.replace("props", key, F.lit('"z"'))).when(k == 1, F.replace("props", key, F.lit('"z": 0, "k"'))).when(k == 2, "{").otherwise(F.col("props"))
    parsed = F.coalesce(F.from_json(p, "map<string,string>"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    return table(spark, sf_dir, "events").select("event_id", F.nullif(F.array_join(expr.missing_keys(parsed, ["k", "z"]), ","), F.lit("")).alias("missing"))


@query("SELECT event_id, coalesce(TRY_CAST(json_extract_string(CASE WHEN json_valid(props) THEN props END, '$.k') AS BIGINT), -1) AS k FROM events")
def json_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", expr.json_get("props", "$.k", "bigint", -1).alias("k"))


@query("SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS stamp FROM events")
def utc_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", expr.utc_stamp("ts").alias("stamp"))


@query("""SELECT p_partkey, regexp_matches(n, '(?:_(?:m|mm|s|kg|pa|k|n|j|w|hz)\\d?)+(?:_per(?:_(?:m|mm|s|kg|pa|k|n|j|w|hz)\\d?)+)?$') AS unit, regexp_matches(lower(n), '_(deg|rad)$') AS angle, regexp_matches(n, '^[a-z][a-z0-9]*(_[a-z0-9]+)*$') AS snake
FROM (SELECT p_partkey, replace(p_name, ' ', '_') || CASE p_size % 6 WHEN 0 THEN '_m_per_s' WHEN 1 THEN '_deg' WHEN 2 THEN '_kg' WHEN 3 THEN 'X' WHEN 4 THEN '_kg_per_m3' ELSE '' END AS n FROM part)""")
def key_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = F.when(F.col("p_size") % 6 == 0, "_m_per_s").when(F.col("p_size") % 6 == 1, "_deg").when(F.col("p_size") % 6 == 2, "_kg").when(F.col("p_size") % 6 == 3, "X").when(F.col("p_size") % 6 == 4, "_kg_per_m3").otherwise("")
    n = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), tail)
    return table(spark, sf_dir, "part").select("p_partkey", rules.unit_suffix(n).alias("unit"), rules.is_angle(n).alias("angle"), rules.snake_case(n).alias("snake"))


@query("SELECT doc_id, sha256(text) AS digest, regexp_matches(sha256(text), '^[0-9a-f]{64}$') AS is_sha, CASE WHEN regexp_full_match(substr(sha256(text), 1, doc_id % 42), '[0-9a-f]{40}') THEN 'full' WHEN regexp_full_match(substr(sha256(text), 1, doc_id % 42), '[0-9a-f]{7,39}') THEN 'short' ELSE 'none' END AS commit_kind FROM documents")
def hash_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2("text", 256)
    return table(spark, sf_dir, "documents").select("doc_id", digest.alias("digest"), rules.is_sha256(digest).alias("is_sha"), rules.commit_kind(F.substring(digest, F.lit(1), (F.col("doc_id") % 42).cast("int"))).alias("commit_kind"))


_TAILS = [".png", "/run.json", ".CSV", ".py", "/setup.txt", "/Main.java", ""]


@query(f"""WITH p AS (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') || list_extract({_TAILS}, CAST(page_id % {len(_TAILS)} + 1 AS INTEGER)) AS u FROM pages), l AS (SELECT u, string_split(u, '/')[1] AS layer, lower(string_split(u, '/')[-1]) AS name FROM p),
k AS (SELECT layer, CASE WHEN name = 'setup.txt' THEN 'setup_report' WHEN name LIKE '%.png' THEN 'image' WHEN name LIKE '%.json' THEN 'json' WHEN name LIKE '%.csv' THEN 'csv' WHEN regexp_matches(name, '\\.(java|py)$') THEN 'code' ELSE 'other' END AS kind, length(u) AS n FROM l)
SELECT layer, kind, count(*) AS files, sum(CASE kind WHEN 'image' THEN 1200 WHEN 'json' THEN round_even(n / 4.0, 0) WHEN 'csv' THEN round_even(n / 2.5, 0) ELSE round_even(n / 3.5, 0) END)::BIGINT AS tokens FROM k GROUP BY ALL""")
def kinds_and_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The addresses of all pages as files of seven endings."""
    tail = F.element_at(F.array(*map(F.lit, _TAILS)), (F.col("page_id") % len(_TAILS) + 1).cast("int"))
    path = F.concat(F.regexp_replace("url", "^[a-z]+://", ""), tail)
    rows = table(spark, sf_dir, "pages").select(ledger.layer_of(path).alias("layer"), ledger.kind_of(path).alias("kind"), F.length(path).alias("n"))
    return rows.groupBy("layer", "kind").agg(F.count(F.lit(1)).alias("files"), F.sum(ledger.tokens_by_kind(F.col("kind"), F.col("n"))).alias("tokens"))


@query("SELECT event_type, round(avg(value), 6) + 0.0 AS mean, round(stddev_pop(value), 6) + 0.0 AS rms FROM events GROUP BY 1")
def rms_about_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = signals.rms_about_mean(table(spark, sf_dir, "events"), ["event_type"], "value")
    return r.withColumn("mean", rounded("mean")).withColumn("rms", rounded("rms"))


@query("SELECT count(*) AS n, round(sum(greatest(s_acctbal, 0)), 2) + 0.0 AS total_weight, sum(s_suppkey)::BIGINT AS total_volume, count(*) FILTER (WHERE NOT s_acctbal > 0) AS zero_weight, min(s_acctbal) AS tracer_min, max(s_acctbal) AS tracer_max FROM supplier")
def sample_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.totals(table(spark, sf_dir, "supplier"), F.col("s_acctbal"), F.col("s_suppkey"), F.col("s_acctbal")).withColumn("total_weight", rounded("total_weight", 2))


# --- feature flow ------------------------------------------------------------------------------------------------------------

_STATIONS = """c AS (SELECT s_suppkey AS node, s_acctbal AS q, CAST(s_suppkey % 12 AS DOUBLE) AS x, CAST((s_suppkey * 7) % 23 AS DOUBLE) AS y, CAST(s_nationkey AS DOUBLE) AS z, CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE -1 END AS sense, 1.0 + s_suppkey % 3 AS volume FROM supplier),
cutoff AS (SELECT * FROM c WHERE z >= 3), st AS (SELECT c.*, s.station FROM cutoff c, (SELECT unnest([2.0, 6.0, 10.0])::DOUBLE AS station) s WHERE abs(x - station) <= 2),
k AS (SELECT * FROM (SELECT *, max(q) OVER (PARTITION BY station) AS peak FROM st) WHERE peak > 0 AND q >= 0.05 * peak),
r AS (SELECT station, sense, 2.5 * quantile_cont(cbrt(volume), 0.5) AS radius FROM k GROUP BY ALL),
e AS (SELECT a.station, a.sense, a.node AS u, b.node AS v FROM k a JOIN k b USING (station, sense) JOIN r USING (station, sense) WHERE (a.y - b.y) ** 2 + (a.z - b.z) ** 2 <= radius * radius),
reach(station, sense, node, root) AS (SELECT station, sense, node, node FROM k UNION SELECT e.station, e.sense, e.v, t.root FROM reach t JOIN e ON e.station = t.station AND e.sense = t.sense AND e.u = t.node),
cl AS (SELECT station, sense, node, min(root) AS cluster FROM reach GROUP BY ALL)"""


def _clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature flow on suppliers: z cut, stations (an edge lies in two), threshold per station, sign, clusters."""
    s = table(spark, sf_dir, "supplier")
    cloud = s.select(F.col("s_suppkey").alias("node"), F.col("s_acctbal").alias("q"), (F.col("s_suppkey") % 12).cast("double").alias("x"), ((F.col("s_suppkey") * 7) % 23).cast("double").alias("y"), F.col("s_nationkey").cast("double").alias("z"), F.when(F.col("s_suppkey") % 2 == 0, 1).otherwise(-1).alias("sense"), (1.0 + F.col("s_suppkey") % 3).alias("volume"))
    binned = features.station_bin(features.cut(cloud, 3.0), [2.0, 6.0, 10.0], 4.0)
    return features.clustered(features.relative_threshold(binned, ["station"], "q", 0.05), ["station", "sense"], "node", "y", "z", "volume", 2.5)


@query(f"WITH RECURSIVE {_STATIONS} SELECT station, sense, node, cluster FROM cl")
def station_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clusters(spark, sf_dir).select("station", "sense", "node", "cluster")


@query(f"WITH RECURSIVE {_STATIONS} SELECT station, round(sum(CASE WHEN sense > 0 THEN q ELSE 0 END), 2) + 0.0 AS positive, round(sum(CASE WHEN sense < 0 THEN q ELSE 0 END), 2) + 0.0 AS negative FROM k GROUP BY 1")
def station_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = _clusters(spark, sf_dir).groupBy("station", "sense", "cluster").agg(F.sum("q").alias("strength"))
    s = features.station_sum(per, ["station"], F.col("sense"), "strength")
    return s.select("station", rounded("positive", 2).alias("positive"), rounded("negative", 2).alias("negative"))


@query(f"WITH {_STATIONS.split(', cutoff')[0].split(chr(10) + 'cutoff')[0].rstrip(',')}, st AS (SELECT c.*, s.station FROM c, (SELECT unnest([2.0, 6.0, 10.0])::DOUBLE AS station) s WHERE abs(x - station) <= 2), k AS (SELECT * FROM (SELECT *, max(q) OVER (PARTITION BY station) AS peak FROM st) WHERE peak > 0 AND q >= 0.05 * peak) SELECT station, sense, round(2.5 * quantile_cont(cbrt(volume), 0.5), 6) + 0.0 AS link_radius FROM k GROUP BY ALL")
def link_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    cloud = s.select(F.col("s_acctbal").alias("q"), (F.col("s_suppkey") % 12).cast("double").alias("x"), F.when(F.col("s_suppkey") % 2 == 0, 1).otherwise(-1).alias("sense"), (1.0 + F.col("s_suppkey") % 3).alias("volume"))
    r = features.link_radius(features.relative_threshold(features.station_bin(cloud, [2.0, 6.0, 10.0], 4.0), ["station"], "q", 0.05), ["station", "sense"], "volume", 2.5)
    return r.withColumn("link_radius", rounded("link_radius"))


@query("SELECT c_nationkey FROM customer WHERE c_acctbal > 0 INTERSECT SELECT c_nationkey FROM customer WHERE c_acctbal < 0")
def common_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return features.common_keys(c.filter("c_acctbal > 0"), c.filter("c_acctbal < 0"), ["c_nationkey"])


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_extendedprice >= 30000")
def export_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.above_floor(table(spark, sf_dir, "lineitem"), 30000, "l_extendedprice").select("l_orderkey", "l_linenumber", "l_partkey")


# --- neighbours, lattices, accounts ----------------------------------------------------------------------------------------------


@query("""WITH c AS (SELECT c_custkey, c_nationkey, c_acctbal AS x, CAST(c_custkey % 41 AS DOUBLE) AS y FROM customer), s AS (SELECT s_suppkey, s_nationkey, s_acctbal AS x, CAST(s_suppkey % 41 AS DOUBLE) AS y FROM supplier),
j AS (SELECT c_custkey, s_suppkey, sqrt((c.x - s.x) ** 2 + (c.y - s.y) ** 2) AS d FROM c JOIN s ON abs(c.x - s.x) <= 300), r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) AS r FROM j WHERE d <= 300)
SELECT c.c_custkey, s_suppkey AS nearest, round(d, 6) + 0.0 AS distance FROM c LEFT JOIN (SELECT * FROM r WHERE r = 1) r USING (c_custkey)""")
def nearest_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("x"), (F.col("c_custkey") % 41).cast("double").alias("y"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_acctbal").alias("x"), (F.col("s_suppkey") % 41).cast("double").alias("y"))
    n = neighbours.nearest_within(c, s, ["x", "y"], 300.0, "c_custkey", "s_suppkey")
    return n.select("c_custkey", "nearest", rounded("distance").alias("distance"))


@query("SELECT s_suppkey, abs(s_acctbal) <= 5000 + 1e-6 AND abs(s_nationkey - 12) <= 6 + 1e-6 AS inside FROM supplier")
def inside_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", lattice.inside_body([F.col("s_acctbal"), F.col("s_nationkey") - 12], [5000, 6]).alias("inside"))


@query("SELECT l_returnflag, round(sum(l_quantity * l_discount) * 0.25, 6) + 0.0 AS integral FROM lineitem GROUP BY 1")
def plane_integral(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = lattice.plane_integral(table(spark, sf_dir, "lineitem"), ["l_returnflag"], F.col("l_quantity") * F.col("l_discount"), 0.25)
    return p.select("l_returnflag", rounded(p.columns[-1]).alias("integral"))


@query("SELECT user_id, round(arg_max(value, (ts, event_id)) - arg_min(value, (ts, event_id)), 6) + 0.0 AS span, arg_max(event_id, (ts, event_id)) - arg_min(event_id, (ts, event_id)) AS steps FROM events GROUP BY 1")
def elapsed_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", F.struct("ts", "event_id").alias("when"), F.col("event_id").alias("steps"), F.col("value").alias("span"))
    return accounts.elapsed_delta(e, ["user_id"], "when", ["span", "steps"]).withColumn("span", rounded("span"))


@query("""WITH c AS (SELECT c_custkey, 'n' || c_nationkey || '/s' || (c_custkey % 5) || '/c' || c_custkey AS start FROM customer), known AS (SELECT 'n' || n_nationkey || '/base' AS spot FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT 'n' || n_nationkey || '/s3/base' FROM nation UNION ALL SELECT 'base' FROM region WHERE r_regionkey = 0),
t AS (SELECT c_custkey, 0 AS climbed, start || '/base' AS spot FROM c UNION ALL SELECT c_custkey, 1, string_split(start, '/')[1] || '/' || string_split(start, '/')[2] || '/base' FROM c UNION ALL SELECT c_custkey, 2, string_split(start, '/')[1] || '/base' FROM c UNION ALL SELECT c_custkey, 3, 'base' FROM c),
h AS (SELECT c_custkey, min(climbed) AS climbed, arg_min(spot, climbed) AS found FROM t WHERE spot IN (SELECT spot FROM known) GROUP BY 1) SELECT c.c_custkey, found, climbed::BIGINT AS climbed FROM c LEFT JOIN h USING (c_custkey)""")
def base_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_of = lambda c: F.col(c).cast("string")
    c = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("n"), text_of("c_nationkey"), F.lit("/s"), (F.col("c_custkey") % 5).cast("string"), F.lit("/c"), text_of("c_custkey")).alias("start"), F.lit("base").alias("base"))
    n = table(spark, sf_dir, "nation")
    known = n.filter("n_nationkey % 2 = 0").select(F.concat(F.lit("n"), text_of("n_nationkey"), F.lit("/base")).alias("place")).unionByName(n.select(F.concat(F.lit("n"), text_of("n_nationkey"), F.lit("/s3/base")).alias("place"))).unionByName(table(spark, sf_dir, "region").filter("r_regionkey = 0").select(F.lit("base").alias("place")))
    return accounts.base_climb(c, known, "start", "base", "place").select("c_custkey", "found", F.col("climbed").cast("bigint").alias("climbed"))


@query("""WITH w AS (SELECT 'nation_' || c_nationkey AS capsule, CASE WHEN min(c_acctbal) < -900 THEN 2 WHEN max(c_acctbal) > 9900 THEN 1 ELSE 0 END AS r, count(*) FILTER (WHERE c_acctbal < -900) AS errors, count(*) FILTER (WHERE c_acctbal > 9900) AS warnings FROM customer GROUP BY 1)
SELECT capsule, CASE r WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END AS status, errors, warnings FROM w""")
def findings_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("capsule"), F.when(F.col("c_acctbal") < -900, "E").when(F.col("c_acctbal") > 9900, "W").alias("severity"))
    return rules.rollup(c.filter("severity IS NOT NULL"), c)


# --- artifacts made of documents and events ---------------------------------------------------------------------------------------

_ART = """a AS (SELECT 'capsule_' || (doc_id % 50) AS capsule, CASE doc_id % 7 WHEN 0 THEN 'setup.txt' WHEN 1 THEN 'planes/plane_' || doc_id || '.csv' WHEN 2 THEN 'planes/plane_' || (doc_id - 1) || '.png' WHEN 3 THEN 'views/V' || doc_id || '.png' WHEN 4 THEN 'a/b/' || doc_id || '.txt' WHEN 5 THEN 'notes' || doc_id || '.md' ELSE 'diffsrc/' || doc_id || '.png' END AS path, CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 13 = 0 THEN text || ' \u2014' ELSE text END AS text FROM documents)"""


def _artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id").cast("string")
    k = F.col("doc_id") % 7
    path = (
        F.when(k == 0, "setup.txt").when(k == 1, F.concat(F.lit("planes/plane_"), i, F.lit(".csv"))).when(k == 2, F.concat(F.lit("planes/plane_"), (F.col("doc_id") - 1).cast("string"), F.lit(".png"))).when(k == 3, F.concat(F.lit("views/V"), i, F.lit(".png")))
        .when(k == 4, F.concat(F.lit("a/b/"), i, F.lit(".txt"))).when(k == 5, F.concat(F.lit("notes"), i, F.lit(".md"))).otherwise(F.concat(F.lit("diffsrc/"), i, F.lit(".png")))
    )
    body = F.when(F.col("doc_id") % 11 == 0, "").when(F.col("doc_id") % 13 == 0, F.concat("text", F.lit(" \u2014"))).otherwise(F.coalesce(F.col("text"), F.lit(""))).cast("binary")
    return table(spark, sf_dir, "documents").select(F.concat(F.lit("capsule_"), (F.col("doc_id") % 50).cast("string")).alias("capsule"), path.alias("path"), body.alias("content"), F.octet_length(body).cast("bigint").alias("length"))


def _check(check):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = check(rules.texts(_artifacts(spark, sf_dir)), None)
        return found.groupBy("capsule", "check_id", "severity", "path").agg(F.count(F.lit(1)).alias("findings"))

    return run


_FOUND = "SELECT capsule, '{0}' AS check_id, severity, path, count(*) AS findings FROM ({1}) GROUP BY ALL"
for _name, _rule, _sql in (
    ("check_required_files", rules.required_files, "SELECT c.capsule, f.path, 'E' AS severity FROM (SELECT DISTINCT capsule FROM a) c, (SELECT unnest(['setup.txt', 'summary.json']) AS path) f WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.capsule = c.capsule AND a.path = f.path)"),
    ("check_declared_files", rules.declared_files, "SELECT capsule, path, 'E' AS severity FROM a WHERE path LIKE 'views/V%' OR path LIKE 'a/b/%' OR path LIKE 'notes%' OR path LIKE 'diffsrc/%'"),
    ("check_not_empty", rules.not_empty, "SELECT capsule, path, 'E' AS severity FROM a WHERE coalesce(text, '') = ''"),
    ("check_no_instrument_dir", rules.no_instrument_dir, "SELECT capsule, path, 'E' AS severity FROM a WHERE path LIKE 'diffsrc/%'"),
    ("check_punctuation", rules.punctuation, "SELECT capsule, path, CASE WHEN path = 'setup.txt' THEN 'W' ELSE 'E' END AS severity FROM a WHERE regexp_matches(path, '\\.(json|txt|csv|java|md)$') AND regexp_matches(coalesce(text, ''), '[\u2013\u2014\u2212]')"),
    ("check_plane_pairs", rules.plane_pairs, "SELECT coalesce(x.capsule, y.capsule) AS capsule, coalesce(x.stem, y.stem) AS path, 'E' AS severity FROM (SELECT DISTINCT capsule, left(path, -4) AS stem FROM a WHERE path LIKE 'planes/%.csv') x FULL JOIN (SELECT DISTINCT capsule, left(path, -4) AS stem FROM a WHERE path LIKE 'planes/%.png') y ON x.capsule = y.capsule AND x.stem = y.stem WHERE x.capsule IS NULL OR y.capsule IS NULL"),
    ("check_csv_header", rules.csv_header, "SELECT capsule, path, 'E' AS severity FROM a WHERE path LIKE '%.csv' AND NOT starts_with(coalesce(text, ''), '#')"),
    ("check_png_geometry", rules.png_geometry, "SELECT capsule, path, 'E' AS severity FROM a WHERE path LIKE '%.png'"),
):
    _run = _check(_rule)
    _run.__name__ = _name
    query(f"WITH {_ART} " + _FOUND.format(_name.removeprefix("check_"), _sql))(_run)


# --- JSON artifacts, one capsule per event: five kinds of each file -----------------------------------------------------------------

_JSON = {
    "summary.json": [
        '{"reference":{"length_m":1},"environment":{"solver":"s","version":"1","build":"b","platform":"p","precision":"double"},"convergence":{"status":"converged"}}',
        '{"environment":{"solver":"s","precision":"half"},"status":"draft","lift_n":2.5}',
        '{"reference":{"velocity":3},"_todo":1,"extensions":["audio"],"convergence":{"status":"fine"}}',
        "{,",
        '{"reference":{"pressure_Pa":3,"rho":{"value":1,"unit":"kg"}},"numerics":{}}',
    ],
    "manifest.json": ['{"views":[{"colorbar":{"signed":true,"range":[-2,2]}}]}', '{"views":[{"colorbar":{"signed":true,"range":[-1,2]}}]}', '{"views":[{"colorbar":{"signed":1}}]}', '{"views":[{"colorbar":{"signed":true}}]}', "{}"],
    "diff.json": ['{"base":{"commit":"main"}}', "{}", "[]", '{"schema_version":"1","base":{"alias":"a","repo":"r","commit":"0000000","path":"p","frozen_copy_path":"f"},"variant":{},"difference":{},"view_contract":{"colorbar_levels":256},"pipeline":{"pixels_evaluated":1},"pairs":[],"scalar_deltas":{},"known_differences":[]}', '{"pairs":1}'],
    "modes/modes.json": ['{"modes":[{"energy_fraction":0.7,"cumulative":0.7},{"energy_fraction":0.2995,"cumulative":0.9995}]}', '{"modes":[{"energy_fraction":0.7,"cumulative":0.9}]}', '{"modes":[{"energy_fraction":1.7,"cumulative":1.7}]}', '{"modes":[{"energy_fraction":0.5,"cumulative":0.5}]}', '{"modes":[{"energy_fraction":0.9999,"cumulative":0.9999}]}'],
}


def _json_artifacts(spark: SparkSession, sf_dir: str, file: str) -> tuple[DataFrame, DataFrame]:
    body = F.element_at(F.array(*map(F.lit, _JSON[file])), (F.col("event_id") % 5 + 1).cast("int")).cast("binary")
    a = rules.texts(table(spark, sf_dir, "events").select(F.concat(F.lit("capsule_"), F.col("event_id").cast("string")).alias("capsule"), F.lit(file).alias("path"), body.alias("content"), F.octet_length(body).cast("bigint").alias("length")))
    return a, stored(rules.json_nodes(a.select("capsule", F.col("path").alias("file"), "text")), "nodes")


def _json_check(check, file: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return check(*_json_artifacts(spark, sf_dir, file)).select("capsule", "severity").distinct()

    return run


_AT = "json_extract(t, '$.{0}') IS NOT NULL"
for _rule, _file, _severity, _when in (
    (rules.json_parses, "summary.json", "E", "NOT json_valid(t)"),
    (rules.environment, "summary.json", "W", "json_extract(t, '$.environment') IS NULL OR json_extract(t, '$.numerics') IS NOT NULL OR json_extract(t, '$.environment.version') IS NULL OR json_extract_string(t, '$.environment.precision') NOT IN ('single', 'double', 'mixed')"),
    (rules.reference_block, "summary.json", "E", "json_extract(t, '$.reference') IS NULL"),
    (rules.dimensional_flags, "summary.json", "W", f"{_AT.format('lift_n')} OR {_AT.format('reference.velocity')} OR {_AT.format('reference.pressure_Pa')} OR {_AT.format('reference.rho.unit')}"),
    (rules.publication_residue, "summary.json", "W", f"{_AT.format('status')} OR {_AT.format('_todo')}"),
    (rules.extensions, "summary.json", "E", "json_extract_string(t, '$.extensions[0]') <> 'diff'"),
    (rules.summary_blocks, "summary.json", "W", "json_extract_string(t, '$.convergence.status') NOT IN ('converged', 'stationary', 'not_stationary', 'no_steady_state')"),
    (rules.signed_range, "manifest.json", "W", "json_type(t, '$.views[0].colorbar.signed') <> 'BOOLEAN' OR json_extract_string(t, '$.views[0].colorbar.signed') = 'true' AND (json_extract(t, '$.views[0].colorbar.range') IS NULL OR json_extract(t, '$.views[0].colorbar.range[0]')::DOUBLE + json_extract(t, '$.views[0].colorbar.range[1]')::DOUBLE <> 0)"),
    (rules.diff_manifest, "diff.json", "E", "json_type(t) = 'OBJECT' AND (json_extract(t, '$.known_differences') IS NULL OR json_type(t, '$.pairs') <> 'ARRAY')"),
    (rules.transient_layers, "modes/modes.json", "W", "abs(json_extract(t, '$.modes[0].energy_fraction')::DOUBLE - json_extract(t, '$.modes[0].cumulative')::DOUBLE) > 1e-3 OR json_extract(t, '$.modes[0].energy_fraction')::DOUBLE > 1 OR greatest(json_extract(t, '$.modes[0].cumulative')::DOUBLE, coalesce(json_extract(t, '$.modes[1].cumulative')::DOUBLE, 0)) < 0.998"),
):
    _run = _json_check(_rule, _file)
    _run.__name__ = f"check_{_rule.__name__}"
    _texts = ", ".join("'" + t.replace("'", "''") + "'" for t in _JSON[_file])
    query(f"WITH a AS (SELECT 'capsule_' || event_id AS capsule, list_extract([{_texts}], CAST(event_id % 5 + 1 AS INTEGER)) AS t FROM events) SELECT capsule, '{_severity}' AS severity FROM a WHERE CASE WHEN {'true' if _rule is rules.json_parses else 'json_valid(t)'} THEN {_when} ELSE false END" + (" UNION ALL SELECT capsule, 'W' FROM a WHERE json_extract_string(t, '$.base.commit') = '0000000'" if _rule is rules.diff_manifest else ""))(_run)


# --- texts -----------------------------------------------------------------------------------------------------


_SIGNS = ["p_name || chr(9)", "'  @k=0..3 ' || p_name", "p_name || chr(10) || '@k=0..12 x'", "p_name || ' ^'", "'@k=0..3' || p_name || '^'", "p_name || '{-1:2.5}'", "p_name || '{a:2}'", "p_name"]


@query(f"SELECT p_partkey, regexp_matches(CASE p_partkey % 8 {' '.join(f'WHEN {k} THEN {t}' for k, t in enumerate(_SIGNS))} END, '\\t|\\{{-?[0-9]+(\\.[0-9]+)?:-?[0-9]+(\\.[0-9]+)?\\}}|(^|\\n) *@k=0\\.\\.[0-9]+ | \\^') AS marks FROM part")
def setup_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts with each of the marks, with what only looks like them, and as they are."""
    n = F.col("p_name")
    forms = [F.concat(n, F.lit("\t")), F.concat(F.lit("  @k=0..3 "), n), F.concat(n, F.lit("\n@k=0..12 x")), F.concat(n, F.lit(" ^")), F.concat(F.lit("@k=0..3"), n, F.lit("^")), F.concat(n, F.lit("{-1:2.5}")), F.concat(n, F.lit("{a:2}")), n]
    form = F.coalesce(*[F.when(F.col("p_partkey") % 8 == k, f) for k, f in enumerate(forms)])
    return table(spark, sf_dir, "part").select("p_partkey", text.has_marks(form).alias("marks"))


# --- files written and read again ----------------------------------------------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder for exports."""
    return f"{shared_base(spark).rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"


@query("SELECT s_suppkey::DOUBLE AS x, s_acctbal AS volume FROM supplier WHERE s_acctbal > 0")
def csv_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers exported with units in the header; rows without a positive volume are rejected."""
    path = _folder(spark, "csv")
    table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("X (m)"), F.col("s_name").alias("note"), F.col("s_acctbal").alias("Volume (m^3)")).coalesce(1).write.csv(path, header=True)
    return readers.read_csv_strict(spark, path, {"x": "X", "volume": "Volume"}, positive=("volume",))[0]


@query("""WITH r AS (SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 3 THEN 'n/a' ELSE CAST(s_acctbal AS VARCHAR) END AS volume, s_acctbal, row_number() OVER (ORDER BY s_suppkey) + 1 AS line FROM supplier)
SELECT volume, CASE WHEN s_suppkey % 5 = 3 THEN 'volume is not a finite number' ELSE 'volume is not positive' END AS reason, line FROM r WHERE s_suppkey % 5 = 3 OR s_acctbal <= 0""")
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers exported in order, a fifth without a number: what is rejected, why, and in which line."""
    path = _folder(spark, "csv")
    volume = F.when(F.col("s_suppkey") % 5 == 3, "n/a").otherwise(F.col("s_acctbal").cast("string"))
    table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("X (m)"), volume.alias("Volume (m^3)")).coalesce(1).sortWithinPartitions("X (m)").write.csv(path, header=True)
    return readers.read_csv_strict(spark, path, {"x": "X", "volume": "Volume"}, positive=("volume",))[1].select("volume", "reason", "line")


@query("SELECT n_nationkey::BIGINT AS a, n_name AS b FROM nation")
def csv_commented(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "txt")
    n = table(spark, sf_dir, "nation").orderBy("n_nationkey")
    lines = n.agg(F.concat_ws("\n", F.lit("# nations"), F.lit("a,b"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda s: F.concat_ws(",", s["n_nationkey"].cast("string"), s["n_name"])), "\n")).alias("value"))
    lines.coalesce(1).write.text(path)
    return readers.read_csv_commented(spark, path, "a bigint, b string")[0]


@query("SELECT sha256(p_name) AS sha256, 'p/' || p_partkey AS path FROM part")
def hash_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "list")
    table(spark, sf_dir, "part").select(F.concat(F.sha2("p_name", 256), F.lit("  p/"), F.col("p_partkey").cast("string")).alias("value")).write.text(path)
    return readers.read_hash_list(spark, path)


@query("SELECT 'capsule_x' AS capsule, r_regionkey || '.txt' AS path, length(r_name)::BIGINT + 1 AS length, sha256(r_name || chr(10)) AS digest FROM region")
def artifact_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of small files, as an export leaves it: the tasks write one file per region."""
    root = _folder(spark, "tree")
    table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("file"), F.col("r_name").alias("value")).write.partitionBy("file").text(f"{root}/capsule_x")
    files = readers.scan_artifacts(spark, root).filter(F.col("path").rlike(r"/part-[^/]*\.txt$"))
    return files.select("capsule", F.concat(F.regexp_extract("path", r"^file=([^/]*)/", 1), F.lit(".txt")).alias("path"), "length", F.sha2("content", 256).alias("digest"))


@query("SELECT n_regionkey::INT AS region, n_name AS name FROM nation")
def project_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("Name [text]"), F.col("n_nationkey").alias("Key"), F.col("n_regionkey").cast("int").alias("Region (id)"))
    return readers.project_named(n, {"region": "Region", "name": "Name"})


# --- agreements, sets and corrections --------------------------------------------------------------------------------------------


@query("SELECT round(a, 2) + 0.0 AS route_a, round(b, 2) + 0.0 AS route_b, abs(a - b) / greatest(abs(a), abs(b)) < 1e-9 AS agree FROM (SELECT sum(o_totalprice) AS a FROM orders), (SELECT sum(v) AS b FROM (SELECT sum(o_totalprice) AS v FROM orders GROUP BY o_custkey))")
def two_route_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = accounts.two_route_check(o.agg(F.sum("o_totalprice").alias("v")), o.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("p")).agg(F.sum("p").alias("v")), "v")
    return c.select(rounded("route_a", 2).alias("route_a"), rounded("route_b", 2).alias("route_b"), (F.col("difference") < 1e-9).alias("agree"))


@query("""WITH a AS (SELECT count(*) AS n, max(l_partkey) AS top FROM lineitem), o AS (SELECT sum(k)::BIGINT AS n, max(top) AS top FROM (SELECT count(*) AS k, max(l_partkey) AS top FROM lineitem GROUP BY l_orderkey)), s AS (SELECT sum(k)::BIGINT AS n, max(top) AS top FROM (SELECT count(*) AS k, max(l_partkey) AS top FROM lineitem GROUP BY l_suppkey)),
b AS (SELECT count(*) AS n, max(l_partkey) AS top FROM lineitem WHERE l_returnflag <> 'R')
SELECT 'all' AS of, a.n, a.top, a.n = o.n AND a.n = s.n AND a.top = o.top AND a.top = s.top AS agree FROM a, o, s UNION ALL SELECT 'returns left out', a.n, a.top, a.n = o.n AND a.n = b.n AND a.top = o.top AND a.top = b.top FROM a, o, b""")
def three_way_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines counted at once, by order and by supplier; and once with the returned lines left out."""
    li = table(spark, sf_dir, "lineitem")
    one = lambda rows: rows.agg(F.count(F.lit(1)).alias("n"), F.max("l_partkey").alias("top"))
    by = lambda key: li.groupBy(key).agg(F.count(F.lit(1)).alias("k"), F.max("l_partkey").alias("top")).agg(F.sum("k").alias("n"), F.max("top").alias("top"))
    agreed = lambda name, last: diff.three_way_equal([one(li), by("l_orderkey"), last], ["n", "top"]).withColumn("of", F.lit(name))
    return agreed("all", by("l_suppkey")).unionByName(agreed("returns left out", one(li.filter("l_returnflag <> 'R'"))))


@query("""WITH a AS (SELECT DISTINCT p_type FROM part WHERE p_size <= 20), b AS (SELECT DISTINCT p_type FROM part WHERE p_size > 20)
SELECT (SELECT coalesce(string_agg(p_type, ',' ORDER BY p_type), '') FROM a WHERE p_type NOT IN (FROM b)) AS only_first, (SELECT coalesce(string_agg(p_type, ',' ORDER BY p_type), '') FROM b WHERE p_type NOT IN (FROM a)) AS only_second, (SELECT coalesce(string_agg(p_type, ',' ORDER BY p_type), '') FROM a WHERE p_type IN (FROM b)) AS both_sides""")
def key_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_type", F.when(F.col("p_size") <= 20, "low").otherwise("high").alias("side"))
    k = accounts.key_sets(p, "side", "p_type", ("low", "high"))
    return k.select(F.array_join("only_first", ",").alias("only_first"), F.array_join("only_second", ",").alias("only_second"), F.array_join("both", ",").alias("both_sides"))


@query("SELECT event_id, event_id % 3 <> 0 AS equal FROM events")
def contract_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two spellings of one contract; every third differs in value."""
    e = table(spark, sf_dir, "events")
    a = e.select("event_id", F.concat(F.lit('{"a": 1, "b": '), F.col("event_id").cast("string"), F.lit("}")).alias("c"))
    b = e.select("event_id", F.concat(F.lit('{ "b":'), (F.col("event_id") + F.when(F.col("event_id") % 3 == 0, 1).otherwise(0)).cast("string"), F.lit(',"a":1 }')).alias("c"))
    return accounts.contract_equal(a, b, ["event_id"], "c")


@query("SELECT vec_id, abs(vec_id % 256 - 128) <= 2 AND (vec_id % 7 <> 0 OR abs(128 - 0) <= 2) AS masked FROM embeddings")
def corners_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures of two pixels: the left one carries the id, the right one is the mask except on every seventh."""
    v = (F.col("vec_id") % 256).cast("int")
    other = F.when(F.col("vec_id") % 7 == 0, 0).otherwise(128)
    frames = table(spark, sf_dir, "embeddings").select("vec_id", F.lit(2).alias("width"), F.array(v, v, v, other, other, other).alias("pixels"))
    return accounts.corners_masked(frames, (128, 128, 128)).select("vec_id", "masked")


@query("""WITH n AS (SELECT c_nationkey, c_mktsegment AS track, count(*) OVER (PARTITION BY c_nationkey, c_mktsegment) AS n, c_custkey FROM customer), s AS (SELECT c_nationkey, count(DISTINCT track) FILTER (WHERE n < 10) AS fragments FROM n GROUP BY 1)
SELECT n.c_nationkey, track, c_custkey, fragments FROM n JOIN s USING (c_nationkey) WHERE n >= 10""")
def long_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_nationkey", F.col("c_mktsegment").alias("track"), "c_custkey")
    return features.long_tracks(c, ["c_nationkey"], 10).withColumn("fragments", F.col("fragments").cast("bigint"))


@query("""WITH s AS (SELECT l_suppkey, (l_linenumber + l_suppkey % 3)::DOUBLE AS t, sum(l_quantity) AS y FROM lineitem GROUP BY ALL), d AS (SELECT *, lead(t) OVER (PARTITION BY l_suppkey ORDER BY t) - t AS dt, min(t) OVER (PARTITION BY l_suppkey) AS a, max(t) OVER (PARTITION BY l_suppkey) AS b FROM s),
k AS (SELECT *, first_value(dt) OVER (PARTITION BY l_suppkey ORDER BY t) AS step FROM d) SELECT l_suppkey, t, a <= 2 + step / 2 AND b >= 5 - step / 2 AS spans FROM k WHERE t BETWEEN 2 - 1e-6 * step AND 5 + 1e-6 * step""")
def search_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", (F.col("l_linenumber") + F.col("l_suppkey") % 3).cast("double").alias("t")).agg(F.sum("l_quantity").alias("y"))
    return signals.search_window(s, ["l_suppkey"], 2.0, 5.0).select("l_suppkey", "t", "spans")


@query("WITH s AS (SELECT DISTINCT l_suppkey, l_linenumber::DOUBLE AS t FROM lineitem) SELECT l_suppkey, t FROM (SELECT *, min(t) OVER (PARTITION BY l_suppkey) AS a FROM s) WHERE t > greatest(a + 0.01, 3)")
def settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_linenumber").cast("double").alias("t")).distinct()
    return signals.settled(s, ["l_suppkey"], 3.0)


@query("""SELECT o_orderkey, round(24.0 / re * (1 + 0.15 * pow(re, 0.681)) + 0.407 / (1 + 8710 * pow(re, -1)), 6) + 0.0 AS drag, round(-3.3265 / re + 0.1816 + 1.6e-4 * re, 6) + 0.0 AS strouhal, round((re - 150) / 150 * 100, 6) + 0.0 AS percent, 're' || lpad(CAST(CAST(re AS BIGINT) AS VARCHAR), 4, '0') AS alias
FROM (SELECT o_orderkey, 50.0 + o_orderkey % 400 AS re FROM orders)""")
def correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", (50.0 + F.col("o_orderkey") % 400).alias("re"))
    return o.select("o_orderkey", rounded(expr.drag_correlation("re", 0.15, 0.681, 0.407, 8710, -1)).alias("drag"), rounded(expr.strouhal_correlation("re")).alias("strouhal"), rounded(expr.percent_error("re", F.lit(150.0))).alias("percent"), expr.sweep_alias("re", F.col("re").cast("bigint")).alias("alias"))


@query("SELECT p_partkey, p_size * (p_retailprice - 100) / 256 AS level, (p_size % 5 + p_partkey % 5 + 2) / 3.0 AS grey, p_size % 5 = p_partkey % 5 AND p_size % 5 = 2 AS is_grey, trim(regexp_replace(p_name || ' (m)', '\\s*\\(.*$', '')) AS base FROM part")
def colours_and_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, g, b = F.col("p_size") % 5, F.col("p_partkey") % 5, F.lit(2)
    return table(spark, sf_dir, "part").select("p_partkey", expr.level_value("p_size", F.lit(100.0), "p_retailprice").alias("level"), expr.grey(r, g, b).alias("grey"), expr.is_grey(r, g, b).alias("is_grey"), expr.header_base(F.concat("p_name", F.lit(" (m)"))).alias("base"))


@query("SELECT event_type, round(avg(value), 6) + 0.0 AS mean, round(sqrt(greatest(var_pop(value), 0)), 6) + 0.0 AS rms, count(*) AS n FROM events GROUP BY 1")
def running_field_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.streaming.gate import running_field_stats as running

    r = running(table(spark, sf_dir, "events").select("event_type", "value"), "event_type", "value")
    return r.withColumn("mean", rounded("mean")).withColumn("rms", rounded("rms"))


# --- modes -----------------------------------------------------------------------------------------------------------------


@query("SELECT l_suppkey, year(l_shipdate) AS step, round(sum(CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE / 1e6, 4) + 0.0 AS u FROM lineitem GROUP BY ALL")
def pod_reconstruct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly revenue per supplier, taken apart into all modes and put together again."""
    li = table(spark, sf_dir, "lineitem")
    m = li.groupBy("l_suppkey", F.year("l_shipdate").alias("step")).agg((F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double") / 1e6).alias("u"))
    _, modes, coefficients = modal.pod(m, "l_suppkey", "step", ["u"], share=1.0)
    mean = m.groupBy("l_suppkey").agg(F.avg("u").alias("u"))
    back = modal.reconstruct(modes, coefficients, "l_suppkey", "step", ["u"], mean)
    return back.join(m.select("l_suppkey", "step"), ["l_suppkey", "step"]).withColumn("u", rounded("u", 4))


# --- the moving stop ----------------------------------------------------------------------------------------------------------


@query("""WITH e AS (SELECT user_id, event_id, sin(event_id * 0.7) AS a, cos(event_id * 0.3) AS b FROM events), w AS (SELECT user_id, event_id, count(*) OVER k AS n, degrees(atan2(avg(b) OVER k, avg(a) OVER k)) AS angle FROM e WINDOW k AS (PARTITION BY user_id ORDER BY event_id ROWS 6 PRECEDING)),
h AS (SELECT *, n >= 7 AND abs((angle - 60) - 360 * round((angle - 60) / 360)) <= 15 AS near FROM w)
SELECT user_id, CASE WHEN bool_or(near) THEN 'angle' ELSE 'end' END AS reason, coalesce(min(event_id) FILTER (WHERE near), max(event_id)) AS stopped_at, round(coalesce(arg_min(angle, event_id) FILTER (WHERE near), arg_max(angle, event_id)), 6) + 0.0 AS angle FROM h GROUP BY 1""")
def moving_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.sin(F.col("event_id") * 0.7).alias("a"), F.cos(F.col("event_id") * 0.3).alias("b"))
    return windows.moving_stop(e, ["user_id"], "event_id", "a", "b", 60.0, 15.0).withColumn("angle", rounded("angle"))
