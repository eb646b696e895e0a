"""Queries of the engine's own operators on the standard tables, each with its DuckDB counterpart.

Floating results are rounded the same way on both sides, and money is summed as decimals, so that the order of partial
sums does not show.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import reduce90, rounded, tokens_of
from tidemark.operators import accounts, diff, features, lattice, ledger, modal, neighbours, sample, signals, text, windows
from tidemark.operators.ordered import numbered
from tidemark.operators.rules import json_leaves
from tidemark.session import shared_base, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


# --- event windows -------------------------------------------------------------------------------------------------

SIZE = 50


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_type", "ts", "event_id", "value")
    return numbered(e, ["event_type"], ["ts", "event_id"], F.date_trunc("day", "ts"))


def _stats(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = _events(spark, sf_dir)
    return e, windows.schmitt_cycles(e, windows.window_stats(e, SIZE, ["event_type"]), SIZE, ["event_type"])


_E = """
e AS (SELECT event_type, ts, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS i FROM events),
s AS (SELECT event_type, i // 50 AS win, count(*) AS n, avg(value) AS mean, stddev_samp(value) AS sd, min(value) AS least, max(value) AS most
      FROM e GROUP BY ALL HAVING count(*) = 50),
st AS (SELECT e.event_type, s.win, e.i, CASE WHEN value > mean + 0.1 * sd THEN 1 WHEN value < mean - 0.1 * sd THEN -1 END AS state
       FROM e JOIN s ON e.event_type = s.event_type AND e.i // 50 = s.win),
x AS (SELECT event_type, win, state, lag(state) OVER (PARTITION BY event_type, win ORDER BY i) AS before FROM st WHERE state IS NOT NULL),
c AS (SELECT event_type, win, count(*) FILTER (WHERE before <> state) AS crossings FROM x GROUP BY ALL),
w AS (SELECT s.*, coalesce(crossings, 0) AS crossings, coalesce(crossings, 0) // 2 AS cycles FROM s LEFT JOIN c USING (event_type, win)),
p AS (SELECT *, lag(mean) OVER o AS m0, lag(sd) OVER o AS s0, lag(cycles) OVER o AS c0 FROM w WINDOW o AS (PARTITION BY event_type ORDER BY win)),
q AS (SELECT *, least(c0, cycles) AS nc, mean - m0 AS drift, sqrt((s0 * s0 + sd * sd) / least(c0, cycles)) AS se FROM p WHERE m0 IS NOT NULL),
g AS (SELECT event_type, win, drift, CASE WHEN nc >= 10 THEN abs(drift) / se END AS over_se, CASE WHEN nc >= 10 THEN abs(ln(sd / s0)) / (3 / sqrt(nc)) END AS ratio FROM q),
gp AS (SELECT *, coalesce(over_se <= 2 AND ratio <= 1, false) AS passed FROM g),
v AS (SELECT w.event_type, w.win, CASE WHEN sd <= 1e-4 * greatest(abs(mean), 1) THEN 1 WHEN coalesce(passed, false) THEN 2 WHEN w.win + 1 >= 7 THEN 3 END AS rank
      FROM w LEFT JOIN gp USING (event_type, win)),
d AS (SELECT event_type, min(win) AS win, arg_min(rank, win) AS rank FROM v WHERE rank IS NOT NULL GROUP BY event_type),
dec AS (SELECT DISTINCT w.event_type, CASE rank WHEN 1 THEN 'converged' WHEN 2 THEN 'stationary' WHEN 3 THEN 'no_steady_state' ELSE 'unfinished' END AS status, d.win, (d.win + 1) * 50 - 1 AS stopped_at
        FROM w LEFT JOIN d USING (event_type))
"""


@query(f'WITH {_E} SELECT event_type, win AS window_no, n, round(mean, 6) + 0.0 AS mean, round(sd, 6) + 0.0 AS sd, least, most FROM s')
def window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = windows.window_stats(_events(spark, sf_dir), SIZE, ["event_type"])
    return s.select("event_type", F.col("window").alias("window_no"), "n", rounded("mean").alias("mean"), rounded("sd").alias("sd"), "least", "most")


@query(f'WITH {_E} SELECT event_type, win AS window_no, crossings, cycles FROM w')
def schmitt_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir)[1].select("event_type", F.col("window").alias("window_no"), "crossings", "cycles")


@query(f'WITH {_E} SELECT event_type, win AS window_no, round(drift, 6) + 0.0 AS drift, round(over_se, 6) + 0.0 AS drift_over_se, round(ratio, 6) + 0.0 AS sd_ratio_over_tol, passed FROM gp')
def stationarity_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = windows.stationarity_gate(_stats(spark, sf_dir)[1], ["event_type"])
    return g.select("event_type", F.col("window").alias("window_no"), *[rounded(c).alias(c) for c in ("drift", "drift_over_se", "sd_ratio_over_tol")], "passed")


def _decision(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e, s = _stats(spark, sf_dir)
    return e, windows.stop_decision(s, windows.stationarity_gate(s, ["event_type"]), ["event_type"], [], SIZE)


_KINDS = "event_type || '/' || (event_id % 4)"
_SHAPES = "CASE event_id % 4 WHEN 0 THEN 5 + value * 1e-9 WHEN 1 THEN value + event_id WHEN 2 THEN value ELSE value * (1 + user_id % 2 * 4) END"


@query(f"WITH {_E.replace('event_id, value, row_number', f'event_id, {_SHAPES} AS value, row_number', 1).replace('SELECT event_type, ts', f'SELECT {_KINDS} AS event_type, ts', 1).replace('PARTITION BY event_type ORDER BY ts', f'PARTITION BY {_KINDS} ORDER BY ts', 1)} SELECT event_type, status, win AS window_no, stopped_at FROM dec")
def stop_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a type in four runs: one made flat, one with a drift, two as they are."""
    k = F.col("event_id") % 4
    shaped = F.when(k == 0, 5 + F.col("value") * 1e-9).when(k == 1, F.col("value") + F.col("event_id")).when(k == 2, F.col("value")).otherwise(F.col("value") * (1 + F.col("user_id") % 2 * 4))
    e = table(spark, sf_dir, "events").select(F.concat("event_type", F.lit("/"), k.cast("string")).alias("event_type"), "ts", "event_id", shaped.alias("value"))
    e = numbered(e, ["event_type"], ["ts", "event_id"], F.date_trunc("day", "ts"))
    s = windows.schmitt_cycles(e, windows.window_stats(e, SIZE, ["event_type"]), SIZE, ["event_type"])
    return windows.stop_decision(s, windows.stationarity_gate(s, ["event_type"]), ["event_type"], [], SIZE).withColumnRenamed("window", "window_no")


@query(f"""WITH {_E} SELECT e.event_type, status, round(CASE WHEN status = 'converged' THEN arg_max(value, i) ELSE avg(value) END, 6) + 0.0 AS published,
round(CASE WHEN status <> 'converged' THEN stddev_samp(value) END, 6) + 0.0 AS sd, min(value) AS least, max(value) AS most, count(*) AS samples, (max(i) + 1) // 50 AS windows
FROM e JOIN dec ON e.event_type = dec.event_type AND e.i <= stopped_at GROUP BY e.event_type, status""")
def pooled_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, d = _decision(spark, sf_dir)
    out = windows.pooled_publish(e, d.drop("window"), SIZE, ["event_type"], [])
    return out.withColumn("published", rounded("published")).withColumn("sd", rounded("sd"))


@query(f"WITH {_E} SELECT event_type, min(i) AS diverged_at FROM e WHERE value IS NULL OR isnan(value) OR isinf(value) OR i >= 100 AND abs(value) > 90 GROUP BY event_type")
def divergence_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.col("value").isNull() | F.isnan("value") | (F.abs("value") == float("inf")) | (F.col("i") >= 100) & (F.abs("value") > 90)
    return windows.first_offender(_events(spark, sf_dir), ["event_type"], bad)


# --- daily revenue as a signal -------------------------------------------------------------------------------------

PHASES, BINS = 8, 20


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    t = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    return o.groupBy(t.cast("double").alias("t")).agg(F.sum(money("o_totalprice")).cast("double").alias("y")).withColumn("run", F.lit("all"))


def _signal(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = signals.about_mean(_daily(spark, sf_dir), ["run"])
    return d, signals.upward_crossings(d, ["run"])


_D = """
d0 AS (SELECT CAST(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS t, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y FROM orders GROUP BY 1),
d AS (SELECT t, y - avg(y) OVER () AS y FROM d0),
l AS (SELECT t, y, lag(t) OVER (ORDER BY t) AS t0, lag(y) OVER (ORDER BY t) AS y0, lead(t) OVER (ORDER BY t) AS t1, lead(y) OVER (ORDER BY t) AS y1 FROM d),
x AS (SELECT t0 + (t - t0) * (-y0) / (y - y0) AS tc FROM l WHERE y0 < 0 AND y >= 0),
k AS (SELECT tc, row_number() OVER (ORDER BY tc) - 1 AS k, lead(tc) OVER (ORDER BY tc) AS nx FROM x),
pw AS (SELECT min(tc) AS a, max(tc) AS b, count(*) - 1 AS n FROM k)
"""
_TRAP = """
SELECT half, sum(hi - lo) AS h, sum((hi - lo) * (u + v) / 2) AS s, sum((hi - lo) * (u * u + v * v) / 2) AS q FROM (
  SELECT half, lo, hi, y + (y1 - y) / (t1 - t) * (lo - t) AS u, y + (y1 - y) / (t1 - t) * (hi - t) AS v
  FROM (SELECT half, t, y, t1, y1, greatest(t, a) AS lo, least(t1, b) AS hi FROM l, spans WHERE t1 > a AND t < b)) GROUP BY half
"""


@query(f"WITH {_D} SELECT k, round(tc, 6) + 0.0 AS t_cross FROM k")
def upward_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signal(spark, sf_dir)[1].select("k", rounded("t_cross").alias("t_cross"))


@query(f"WITH {_D} SELECT round(a, 6) + 0.0 AS t_start, round(b, 6) + 0.0 AS t_end, n AS periods, round(n / (b - a), 6) + 0.0 AS frequency FROM pw")
def period_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = signals.period_window(_signal(spark, sf_dir)[1], ["run"])
    return p.select(rounded("t_start").alias("t_start"), rounded("t_end").alias("t_end"), "periods", rounded("frequency").alias("frequency"))


@query(f"WITH {_D}, spans AS (SELECT 'whole' AS half, a, b FROM pw), z AS ({_TRAP}) SELECT round(s / h, 4) + 0.0 AS time_mean, round(sqrt(greatest(q / h - (s / h) * (s / h), 0)), 3) + 0.0 AS time_rms FROM z")
def period_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, c = _signal(spark, sf_dir)
    span = c.groupBy("run").agg(F.lit("whole").alias("half"), F.min("t_cross").alias("a"), F.max("t_cross").alias("b"))
    return signals.trapezoid_stats(d, span, ["run"], ["half"]).select(rounded("time_mean", 4).alias("time_mean"), rounded("time_rms", 3).alias("time_rms"))


@query(f"""WITH {_D}, c AS (SELECT k.k, greatest(max(d.y), 0) - least(min(d.y), 0) AS p FROM k JOIN d ON d.t >= k.tc AND d.t < k.nx GROUP BY k.k)
SELECT round(avg(p), 4) + 0.0 AS peak_to_peak, round(avg(p) / 2, 4) + 0.0 AS amplitude, count(*) AS cycles FROM c""")
def peak_to_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, c = _signal(spark, sf_dir)
    return signals.peak_to_peak(d, c, ["run"]).select(rounded("peak_to_peak", 4).alias("peak_to_peak"), rounded("amplitude", 4).alias("amplitude"), "cycles")


@query(f"""WITH {_D}, hh AS (SELECT n, n // 2 AS h FROM pw), ends AS (SELECT (SELECT tc FROM k WHERE k = 0) AS c0, (SELECT tc FROM k, hh WHERE k = h) AS ch, (SELECT tc FROM k, hh WHERE k = n - h) AS cm, (SELECT tc FROM k, hh WHERE k = n) AS cn),
spans AS (SELECT 'first' AS half, c0 AS a, ch AS b FROM ends UNION ALL SELECT 'second', cm, cn FROM ends UNION ALL SELECT 'whole', c0, cn FROM ends), z AS ({_TRAP}),
r AS (SELECT half, s / h AS m, sqrt(greatest(q / h - (s / h) * (s / h), 0)) AS r FROM z),
o AS (SELECT max(m) FILTER (WHERE half = 'first') AS m1, max(m) FILTER (WHERE half = 'second') AS m2, max(m) FILTER (WHERE half = 'whole') AS m3, max(r) FILTER (WHERE half = 'first') AS r1, max(r) FILTER (WHERE half = 'second') AS r2, max(r) FILTER (WHERE half = 'whole') AS r3 FROM r)
SELECT hh.n AS periods, round(m1, 4) + 0.0 AS first_mean, round(m2, 4) + 0.0 AS second_mean, round(r1, 3) + 0.0 AS first_rms, round(r2, 3) + 0.0 AS second_rms, round(abs(r2 - r1) / abs(r3), 6) + 0.0 AS rms_change,
hh.n >= 4 AND abs(m2 - m1) / abs(m3) < 1e-3 AND abs(r2 - r1) / abs(r3) < 1e-3 AS passed FROM o, hh""")
def halves_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, c = _signal(spark, sf_dir)
    h = signals.halves_test(d, c, ["run"])
    return h.select("periods", *[rounded(x, 4).alias(x) for x in ("first_mean", "second_mean")], *[rounded(x, 3).alias(x) for x in ("first_rms", "second_rms")], rounded("rms_change").alias("rms_change"), "passed")


@query(f"""WITH {_D}, c AS (SELECT k, nx - tc AS len FROM k WHERE nx IS NOT NULL)
SELECT round(avg(len), 6) + 0.0 AS mean_length, round(stddev_samp(len), 6) + 0.0 AS sd_length, round(arg_min(len, k), 6) + 0.0 AS first_length, round(arg_max(len, k), 6) + 0.0 AS last_length, count(*) AS cycles FROM c""")
def period_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = signals.period_lengths(_signal(spark, sf_dir)[1], ["run"])
    return p.select(*[rounded(c).alias(c) for c in ("mean_length", "sd_length", "first_length", "last_length")], "cycles")


@query(f"""WITH {_D}, ph AS (SELECT k.k, j AS phase_no, tc + (nx - tc) * j / 8 AS tq FROM k, range(8) r(j) WHERE nx IS NOT NULL),
y AS (SELECT phase_no, y + (y1 - y) * (tq - t) / (t1 - t) AS yq FROM ph ASOF JOIN l ON ph.tq >= l.t)
SELECT CAST(phase_no AS INTEGER) AS phase_no, round(avg(yq), 3) + 0.0 AS mean, round(stddev_samp(yq), 3) + 0.0 AS sd, count(*) AS cycles FROM y GROUP BY 1""")
def phase_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, c = _signal(spark, sf_dir)
    return signals.phase_average(d, c, ["run"], PHASES, 4.0).select("phase_no", rounded("mean", 3).alias("mean"), rounded("sd", 3).alias("sd"), "cycles")


_EVEN = "ev AS (SELECT row_number() OVER (ORDER BY t) - 1 AS i, y, count(*) OVER () AS n FROM d), b AS (SELECT i AS bin FROM range(1, 21) r(i))"


@query(f"""WITH {_D}, {_EVEN}, z AS (SELECT bin, any_value(n) AS n, sum(y * cos(2 * pi() * ((bin * i) % n) / n)) AS c, sum(y * sin(2 * pi() * ((bin * i) % n) / n)) AS s FROM ev, b GROUP BY bin)
SELECT bin, round(2 * (c * c + s * s) / (n * n) / 1e6, 4) + 0.0 AS power FROM z""")
def spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _signal(spark, sf_dir)[0].withColumn("i", F.row_number().over(Window.partitionBy("run").orderBy("t")) - 1)
    return signals.spectrum(d, ["run"], BINS).select("bin", rounded(F.col("power") / 1e6, 4).alias("power"))


@query(f"""WITH {_D}, {_EVEN}, h AS (SELECT i, n, bin, y * (0.5 - 0.5 * cos(2 * pi() * i / (n - 1))) AS y FROM ev, b), z AS (SELECT bin, any_value(n) AS n, sum(y * cos(2 * pi() * ((bin * i) % n) / n)) AS c, sum(y * sin(2 * pi() * ((bin * i) % n) / n)) AS s FROM h GROUP BY bin)
SELECT bin, round((c * c + s * s) / max(c * c + s * s) OVER (), 6) + 0.0 AS power FROM z""")
def hann_spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _signal(spark, sf_dir)[0].withColumn("i", F.row_number().over(Window.partitionBy("run").orderBy("t")) - 1)
    return signals.hann_spectrum(d, ["run"], BINS).select("bin", rounded("power").alias("power"))


@query(f"WITH {_D} SELECT t, round(sum(y) OVER (ORDER BY t ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) / 7, 4) + 0.0 AS smooth FROM d")
def moving_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.moving_mean(_signal(spark, sf_dir)[0], ["run"], 7).select("t", rounded("smooth", 4).alias("smooth"))


@query(f"""WITH {_D}, qs AS (SELECT CAST(i AS INTEGER) AS i, a + (b - a) * i / 1000 AS tq FROM pw, range(1000) r(i))
SELECT i, round(tq, 6) + 0.0 AS tq, round(y + (y1 - y) * (tq - t) / (t1 - t), 3) + 0.0 AS yq FROM qs ASOF JOIN l ON qs.tq >= l.t""")
def linear_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, c = _signal(spark, sf_dir)
    spans = signals.period_window(c, ["run"]).select("run", F.col("t_start").alias("a"), F.col("t_end").alias("b"))
    return signals.linear_resample(d, spans, ["run"], 1000, 4.0).select("i", rounded("tq").alias("tq"), rounded("yq", 3).alias("yq"))


@query()
def fft_lowpass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.fft_lowpass(_signal(spark, sf_dir)[0], ["run"], 30.0)


# --- sampling ------------------------------------------------------------------------------------------------------

_U = "(CAST('0x' || substr(md5('42|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey), 1, 8) AS BIGINT) + 0.5) / 4294967296.0"
_S = f"""
li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS volume, l_quantity * l_discount AS weight, {_U} AS u FROM lineitem),
tot AS (SELECT sum(CAST(volume * 100 AS BIGINT)) / 100.0 AS tv, sum(CAST(round(weight * 100) AS BIGINT)) / 100.0 AS tw FROM li),
sm AS (SELECT *, ln(u) / weight AS sk FROM li WHERE weight > 0 ORDER BY sk DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 800),
vw AS (SELECT sm.*, tw * volume / (count(*) OVER () * weight) AS raw, tv FROM sm, tot),
vs AS (SELECT *, raw * tv / sum(raw) OVER () AS vol_weight, sum(raw) OVER () / tv AS coverage FROM vw)
"""
_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(*_KEYS, F.col("l_quantity").alias("volume"), "l_discount")
    weight = F.col("volume") * F.col("l_discount")
    whole = li.agg((F.sum(F.round(F.col("volume") * 100).cast("bigint")) / 100.0).alias("v"), (F.sum(F.round(weight * 100).cast("bigint")) / 100.0).alias("w")).first()
    return sample.with_volume_weight(sample.importance_sample(li, 800, weight, _KEYS), float(whole["w"] or 0), float(whole["v"] or 0))


@query(f"WITH {_S} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(weight, 6) + 0.0 AS weight, round(sk, 6) + 0.0 AS sample_key FROM sm")
def importance_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sampled(spark, sf_dir).select(*_KEYS, rounded("weight").alias("weight"), rounded("sample_key").alias("sample_key"))


@query(f"WITH {_S} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(vol_weight, 4) + 0.0 AS vol_weight, round(coverage, 6) + 0.0 AS coverage FROM vs")
def vol_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sampled(spark, sf_dir).select(*_KEYS, rounded("vol_weight", 4).alias("vol_weight"), rounded("coverage").alias("coverage"))


@query(f"WITH {_S} SELECT round(sum(weight / volume * vol_weight), 3) + 0.0 AS integral_discount, round(sum(vol_weight), 3) + 0.0 AS total FROM vs")
def estimate_integral(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _sampled(spark, sf_dir).withColumn("discount", F.col("weight") / F.col("volume")).withColumn("one", F.lit(1.0))
    out = sample.estimate_integral(s, "discount", "one")
    return out.select(rounded("integral_discount", 3).alias("integral_discount"), rounded("integral_one", 3).alias("total"))


@query("""WITH g AS (SELECT l_extendedprice AS w, count(*) AS n, sum(CAST(l_quantity AS DECIMAL(18,2))) AS v FROM lineitem GROUP BY 1),
r AS (SELECT w, n, CAST(v AS DOUBLE) AS v, coalesce(sum(n) OVER o, 0) AS n0, CAST(coalesce(sum(CAST(w AS DECIMAL(18,2)) * n) OVER o, 0) AS DOUBLE) AS w0, CAST(coalesce(sum(v) OVER o, 0) AS DOUBLE) AS v0,
 sum(n) OVER () AS an, CAST(sum(CAST(w AS DECIMAL(18,2)) * n) OVER () AS DOUBLE) AS aw, CAST(sum(v) OVER () AS DOUBLE) AS av FROM g WINDOW o AS (ORDER BY w DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
m AS (SELECT CAST(unnest([0.001, 0.01, 0.05, 0.1, 0.25]) AS DOUBLE) AS mark), k AS (SELECT *, greatest(1, ceil(mark * an - 1e-9)) AS k FROM r, m)
SELECT mark, CAST(k AS BIGINT) AS rows, round((w0 + w * least(k - n0, n)) / aw, 6) + 0.0 AS weight_share, round((v0 + v * least(k - n0, n) / n) / av, 6) + 0.0 AS volume_share FROM k WHERE n0 < k AND n0 + n >= k""")
def concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = sample.concentration(table(spark, sf_dir, "lineitem"), F.col("l_extendedprice"), F.col("l_quantity"))
    return c.select("mark", "rows", rounded("weight_share").alias("weight_share"), rounded("volume_share").alias("volume_share"))


# --- features ------------------------------------------------------------------------------------------------------

_M = """
sm AS (SELECT l_suppkey, date_trunc('month', l_shipdate) AS m, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS q FROM lineitem GROUP BY ALL)
"""


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_suppkey", F.date_trunc("month", F.col("l_shipdate").cast("timestamp")).alias("m")).agg(F.sum(money("l_extendedprice")).cast("double").alias("q"))


@query(f"WITH {_M}, p AS (SELECT *, max(q) OVER (PARTITION BY l_suppkey) AS peak FROM sm) SELECT l_suppkey, count(*) AS kept, round(sum(q), 2) + 0.0 AS q FROM p WHERE peak > 0 AND q >= 0.15 * peak GROUP BY l_suppkey")
def relative_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = features.relative_threshold(_monthly(spark, sf_dir), ["l_suppkey"], "q", 0.15)
    return kept.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("kept"), rounded(F.sum("q"), 2).alias("q"))


@query(f"WITH {_M}, p AS (SELECT *, max(q) OVER (PARTITION BY l_suppkey) AS peak FROM sm) SELECT CAST(beta AS DOUBLE) AS beta, count(*) AS kept FROM p, (SELECT unnest([0.1, 0.15, 0.2, 0.4]) AS beta) WHERE q >= CAST(beta AS DOUBLE) * peak AND peak > 0 GROUP BY beta")
def sweep_beta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.sweep_beta(_monthly(spark, sf_dir), ["l_suppkey"], "q", [0.1, 0.15, 0.2, 0.4]).groupBy("beta").agg(F.count(F.lit(1)).alias("kept"))


@query("""SELECT c_mktsegment, CASE WHEN c_acctbal > 0 THEN 1 ELSE -1 END AS sense, count(*) AS cells, round(sum(c_acctbal), 2) + 0.0 AS circulation,
round(sum(abs(c_acctbal) * c_nationkey) / sum(abs(c_acctbal)), 6) + 0.0 AS centroid, round(sqrt(count(*) / pi()), 6) + 0.0 AS effective_radius FROM customer WHERE c_acctbal <> 0 GROUP BY ALL""")
def sign_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = features.with_sense(table(spark, sf_dir, "customer"), "c_acctbal").withColumn("x", F.col("c_nationkey").cast("double"))
    s = features.cluster_summary(c, ["c_mktsegment", "sense"], F.col("c_acctbal"), F.lit(1.0), "c_acctbal", "c_custkey", ["x"], 1.0)
    return s.select("c_mktsegment", "sense", "cells", rounded("circulation", 2).alias("circulation"), rounded("x_mean").alias("centroid"), rounded("effective_radius").alias("effective_radius"))


@query("SELECT p_brand, p_retailprice, p_partkey, p_name, p_size FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS r FROM part) WHERE r = 1")
def argmax_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.argmax_row(table(spark, sf_dir, "part"), ["p_brand"], "p_retailprice", ["p_name", "p_size"], "p_partkey")


@query(f"""WITH {_M}, x AS (SELECT l_suppkey, CAST(datediff('month', DATE '1992-01-01', CAST(m AS DATE)) AS DOUBLE) AS x, q FROM sm),
r AS (SELECT l_suppkey, min(x) AS x_first, max(x) AS x_last, count(*) AS n, avg(q) AS strength_mean, arg_max(q, x) AS strength_last, sum(x * q) / sum(x * x) AS slope, regr_slope(q, x) AS trend FROM x GROUP BY 1),
d AS (SELECT x.l_suppkey, avg(abs(q - slope * x)) AS dist FROM x JOIN r USING (l_suppkey) GROUP BY 1)
SELECT l_suppkey, x_first, x_last, n, round(strength_mean, 2) + 0.0 AS strength_mean, round(strength_last, 2) + 0.0 AS strength_last, round(CASE WHEN n >= 3 THEN slope END, 4) + 0.0 AS dy_dx, round(CASE WHEN n >= 3 THEN trend END, 3) + 0.0 AS dstrength_dx, round(CASE WHEN n >= 3 THEN dist END, 2) + 0.0 AS ray_distance FROM r JOIN d USING (l_suppkey)""")
def track_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _monthly(spark, sf_dir).withColumn("x", ((F.year("m") - 1992) * 12 + F.month("m") - 1).cast("double")).withColumn("flat", F.lit(0.0))
    t = features.track_summary(m, ["l_suppkey"], "x", "q", "flat", "q")
    return t.select("l_suppkey", "x_first", "x_last", "n", rounded("strength_mean", 2).alias("strength_mean"), rounded("strength_last", 2).alias("strength_last"), rounded("dy_dx", 4).alias("dy_dx"), rounded("dstrength_dx", 3).alias("dstrength_dx"), rounded("ray_distance", 2).alias("ray_distance"))


@query("""WITH r AS (SELECT CAST(year(o_orderdate) * 12 + month(o_orderdate) AS DOUBLE) AS x, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderpriority = '1-URGENT') AS DOUBLE) AS a, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderpriority = '5-LOW') AS DOUBLE) AS b FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY 1),
d AS (SELECT x, abs(abs(a) - abs(b)) / greatest(abs(a), abs(b), 1e-30) AS e FROM r WHERE a IS NOT NULL AND b IS NOT NULL)
SELECT count(*) AS stations, round(max(e), 6) + 0.0 AS largest, arg_max(x, e) AS largest_at, round(median(e), 6) + 0.0 AS middle, round(median(e) FILTER (WHERE x >= 23976), 6) + 0.0 AS middle_downstream FROM d""")
def symmetry_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    m = o.groupBy("o_orderpriority", (F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("double").alias("x")).agg(F.sum(money("o_totalprice")).cast("double").alias("v"))
    s = features.symmetry_profile(m, "o_orderpriority", ("1-URGENT", "5-LOW"), "x", "v", 23976.0)
    return s.select("stations", rounded("largest").alias("largest"), "largest_at", rounded("middle").alias("middle"), rounded("middle_downstream").alias("middle_downstream"))


@query("""WITH n AS (SELECT n_regionkey, n_name, n_nationkey % 2 AS sense, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS strength FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL),
r AS (SELECT *, row_number() OVER w AS r, first_value(sense) OVER w AS p FROM n WINDOW w AS (PARTITION BY n_regionkey ORDER BY strength DESC, n_name)),
s AS (SELECT *, min(r) FILTER (WHERE sense <> p) OVER (PARTITION BY n_regionkey) AS s FROM r)
SELECT n_regionkey, n_name, round(strength, 2) + 0.0 AS strength, CASE WHEN r = 1 THEN 'primary' WHEN r = s THEN 'secondary' ELSE 'extra_' || (r - 1 - CASE WHEN s < r THEN 1 ELSE 0 END) END AS label FROM s""")
def rank_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.sum(money("c_acctbal")).cast("double").alias("strength"))
    n = table(spark, sf_dir, "nation").join(per, F.col("n_nationkey") == F.col("c_nationkey")).withColumn("sense", F.col("n_nationkey") % 2)
    out = features.rank_label(n, ["n_regionkey"], "sense", "strength", "n_name")
    return out.select("n_regionkey", "n_name", rounded("strength", 2).alias("strength"), "label")


@query("""WITH a AS (SELECT l_returnflag, var_samp(l_quantity) AS a, var_samp(l_discount * 100) AS b, covar_samp(l_quantity, l_discount * 100) AS c FROM lineitem GROUP BY 1)
SELECT l_returnflag, round(degrees(atan2(2 * c, a - b)) / 2, 4) + 0.0 AS axis_angle, round(1 - ((a + b) / 2 - sqrt(((a - b) / 2) * ((a - b) / 2) + c * c)) / ((a + b) / 2 + sqrt(((a - b) / 2) * ((a - b) / 2) + c * c)), 6) + 0.0 AS planarity FROM a""")
def principal_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", (F.col("l_discount") * 100).alias("d"))
    return features.principal_axis(li, ["l_returnflag"], "l_quantity", "d").select("l_returnflag", rounded("axis_angle", 4).alias("axis_angle"), rounded("planarity").alias("planarity"))


@query("""WITH a AS (SELECT event_type, avg(cos(hour(ts) * pi() / 12)) AS c, avg(sin(hour(ts) * pi() / 12)) AS s FROM events GROUP BY 1)
SELECT event_type, round(degrees(atan2(s, c)), 4) + 0.0 AS mean_angle, round(sqrt(c * c + s * s), 6) + 0.0 AS resultant,
round(CASE WHEN (degrees(atan2(s, c)) + 90 + 360) % 180 - 90 = -90 THEN 90 ELSE (degrees(atan2(s, c)) + 90 + 360) % 180 - 90 END, 4) + 0.0 AS axis FROM a""")
def circular_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = features.mean_angle(table(spark, sf_dir, "events"), ["event_type"], F.hour("ts") * F.lit(math.pi) / 12)
    return m.select("event_type", rounded("mean_angle", 4).alias("mean_angle"), rounded("resultant").alias("resultant"), rounded(reduce90("mean_angle"), 4).alias("axis"))


# --- ranks, neighbours, lattices -----------------------------------------------------------------------------------


@query("SELECT l_returnflag, quantile_disc(l_extendedprice, 0.5) AS p50, quantile_disc(l_extendedprice, 0.95) AS p95, quantile_disc(l_extendedprice, 0.99) AS p99, max(l_extendedprice) AS largest FROM lineitem GROUP BY 1")
def nearest_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_rank(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice")


@query("""WITH v AS (SELECT l_extendedprice / 40000.0 AS v FROM lineitem), e AS (SELECT CAST(unnest([0.0, 0.1, 0.25, 0.5, 0.75, 1.0]) AS DOUBLE) AS e), p AS (SELECT (SELECT count(*) FROM e WHERE e <= v) - 1 AS bin FROM v)
SELECT b.bin, count(p.bin) AS n FROM (SELECT unnest([0, 1, 2, 3, 4, 5])::BIGINT AS bin) b LEFT JOIN p USING (bin) GROUP BY b.bin""")
def histogram_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.histogram_fixed(table(spark, sf_dir, "lineitem"), F.col("l_extendedprice") / 40000.0, [0.0, 0.1, 0.25, 0.5, 0.75, 1.0])


_MIRROR = """WITH c AS (SELECT c_custkey, c_acctbal AS x, CAST(c_nationkey AS DOUBLE) AS y, CASE c_nationkey % 3 WHEN 0 THEN 25.0 WHEN 1 THEN 10.0 ELSE 12.0 END AS size FROM customer),
o AS (SELECT * FROM c WHERE abs(x) > 1e-9 * (SELECT max(size) FROM c)),
j AS (SELECT a.c_custkey, b.c_custkey AS nearest, b.size AS other, sqrt((-a.x - b.x) * (-a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS distance FROM o a JOIN o b ON sign(b.x) = -sign(a.x) ),
r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY distance, nearest) AS r FROM j),
m AS (SELECT o.c_custkey, nearest, distance, distance / size AS delta, CASE WHEN nearest IS NULL OR distance > greatest(size, other) THEN 'unpaired' WHEN abs(log2(size / other)) > 0.5 THEN 'level_mismatch' ELSE 'paired' END AS outcome
      FROM o LEFT JOIN (SELECT * FROM r WHERE r = 1) r USING (c_custkey))"""


def _mirror(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    size = F.when(F.col("c_nationkey") % 3 == 0, 25.0).when(F.col("c_nationkey") % 3 == 1, 10.0).otherwise(12.0)
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("x"), F.col("c_nationkey").cast("double").alias("y"), size.alias("size"))
    return c, neighbours.mirror_pairs(c, "c_custkey", "x", ["x", "y"], "size")


@query(f"{_MIRROR} SELECT c_custkey, nearest, round(distance, 6) + 0.0 AS distance, round(delta, 6) + 0.0 AS delta, outcome FROM m")
def mirror_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mirror(spark, sf_dir)[1].select("c_custkey", "nearest", rounded("distance").alias("distance"), rounded("delta").alias("delta"), "outcome")


@query("""SELECT n_nationkey, count(*) FILTER (WHERE c_acctbal > 0) AS n_positive, count(*) FILTER (WHERE c_acctbal < 0) AS n_negative, round(sum(greatest(c_acctbal, 0)), 2) + 0.0 AS sum_positive, round(-sum(least(c_acctbal, 0)), 2) + 0.0 AS sum_negative,
round(abs(sum(greatest(c_acctbal, 0)) + sum(least(c_acctbal, 0))) / greatest(abs(sum(greatest(c_acctbal, 0))), abs(sum(least(c_acctbal, 0))), 1e-30), 6) + 0.0 AS imbalance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def side_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").withColumn("n_nationkey", F.col("c_nationkey")).withColumn("v", F.abs("c_acctbal"))
    b = neighbours.side_balance(c, ["n_nationkey"], F.col("c_acctbal"), "v")
    return b.select("n_nationkey", "n_positive", "n_negative", rounded("sum_positive", 2).alias("sum_positive"), rounded("sum_negative", 2).alias("sum_negative"), rounded("imbalance").alias("imbalance"))


@query("""WITH e AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events) SELECT u.user_id, count(*) AS missing FROM (SELECT DISTINCT user_id FROM e) u CROSS JOIN (SELECT DISTINCT day FROM e) d
WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.user_id = u.user_id AND e.day = d.day) GROUP BY 1""")
def lattice_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("date").alias("day")).distinct()
    return lattice.lattice_missing(e, "user_id", "day").groupBy("user_id").agg(F.count(F.lit(1)).alias("missing"))


@query("SELECT l_returnflag, min(l_discount) AS v FROM lineitem GROUP BY l_returnflag, round_even(l_discount / 1e-4, 0)")
def lattice_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.lattice_axis(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_discount").select("l_returnflag", F.col("l_discount").alias("v"))


@query(f"""WITH {_D}, s AS (SELECT t1 - t AS d, avg(t1 - t) OVER () AS h FROM l) SELECT count(*) AS values, round(max(h), 6) + 0.0 AS step, round(max(abs(d - h)), 6) + 0.0 AS deviation, count(*) >= 2 AND max(abs(d - h)) <= 1e-4 * greatest(1, abs(max(h))) AS uniform FROM s""")
def uniform_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.uniform_spacing(_daily(spark, sf_dir), ["run"], "t").select("values", rounded("step").alias("step"), rounded("deviation").alias("deviation"), "uniform")


@query("""WITH o AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, o_orderkey - o_custkey AS v FROM orders),
d AS (SELECT *, v - lag(v) OVER w AS d FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY k)), e AS (SELECT *, lag(d) OVER (PARTITION BY o_custkey ORDER BY k) AS p FROM d),
r AS (SELECT *, sum(CASE WHEN d IS NULL OR p IS NULL OR d <> p THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY k) AS run FROM e)
SELECT o_custkey, max(k) AS last, count(*) + 1 AS length, arg_min(v, k) - any_value(d) AS start, any_value(d) AS step FROM r WHERE d IS NOT NULL GROUP BY o_custkey, run HAVING count(*) + 1 >= 3""")
def arithmetic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_custkey", F.row_number().over(w).cast("bigint").alias("k"), (F.col("o_orderkey") - F.col("o_custkey")).alias("v"))
    return lattice.arithmetic_runs(o, ["o_custkey"], "k", "v")


@query("SELECT CAST(floor(l_quantity / 5) AS BIGINT) AS l_quantity_cell, CAST(floor(l_discount / 0.03) AS BIGINT) AS l_discount_cell, count(*) AS n, round(avg(l_extendedprice), 3) + 0.0 AS l_extendedprice FROM lineitem GROUP BY ALL")
def bin_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = lattice.bin_average(table(spark, sf_dir, "lineitem"), {"l_quantity": (0.0, 5.0), "l_discount": (0.0, 0.03)}, "l_extendedprice")
    return b.withColumn("l_extendedprice", rounded("l_extendedprice", 3))


@query(f"""WITH {_D} SELECT max(t) FILTER (WHERE y < 0) AS farthest, round(min(CASE WHEN y0 < 0 AND y >= 0 THEN t0 + (t - t0) * (0 - y0) / (y - y0) END), 6) + 0.0 AS first_crossing FROM l""")
def threshold_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.threshold_extent(_signal(spark, sf_dir)[0], ["run"], "t", "y").select("farthest", rounded("first_crossing").alias("first_crossing"))


# --- differences and ledgers ---------------------------------------------------------------------------------------


@query("""WITH r AS (SELECT c_mktsegment, year(o_orderdate) AS y, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM orders JOIN customer ON c_custkey = o_custkey WHERE year(o_orderdate) IN (1996, 1997) GROUP BY ALL)
SELECT a.c_mktsegment, a.v AS base, b.v AS variant, round(b.v - a.v, 2) + 0.0 AS delta, round((b.v - a.v) / abs(a.v), 6) + 0.0 AS relative FROM r a JOIN r b ON a.c_mktsegment = b.c_mktsegment AND a.y = 1996 AND b.y = 1997 WHERE abs(a.v) > 1e-9""")
def scalar_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    r = o.filter(F.year("o_orderdate").isin(1996, 1997)).groupBy("c_mktsegment", F.year("o_orderdate").alias("y")).agg(F.sum(money("o_totalprice")).cast("double").alias("value"))
    d = diff.scalar_delta(r.filter("y = 1996"), r.filter("y = 1997"), ["c_mktsegment"], digits=2)
    return d.withColumn("relative", rounded("relative"))


@query("""WITH d AS (SELECT doc_id AS path, doc_id % 7 AS k, coalesce(text, '') AS t FROM documents), a AS (SELECT path, sha256(t) AS h FROM d WHERE k <> 1), b AS (SELECT path, sha256(CASE WHEN k = 2 THEN rtrim(t) || '.' ELSE t END) AS h FROM d WHERE k <> 0)
SELECT coalesce(a.path, b.path) AS path, CASE WHEN b.path IS NULL THEN 'missing' WHEN a.path IS NULL THEN 'added' WHEN a.h <> b.h THEN 'changed' ELSE 'same' END AS drift FROM a FULL JOIN b ON a.path = b.path""")
def manifest_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents before and after an edit that drops a seventh of them, adds a seventh and changes a seventh."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), (F.col("doc_id") % 7).alias("k"), F.coalesce("text", F.lit("")).alias("t"))
    before = d.filter("k <> 1").select("path", F.sha2("t", 256).alias("sha256"))
    after = d.filter("k <> 0").select("path", F.sha2(F.when(F.col("k") == 2, F.concat(F.rtrim("t"), F.lit("."))).otherwise(F.col("t")), 256).alias("sha256"))
    return diff.manifest_drift(before, after)


@query("""WITH g AS (SELECT source, 'text' || n_chars AS stem, bool_or(doc_id % 2 = 0) AS a, bool_or(doc_id % 2 = 1) AS b FROM documents GROUP BY ALL)
SELECT source, stem, CASE WHEN a THEN 'odd' ELSE 'even' END AS missing FROM g WHERE a <> b""")
def pair_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: even and odd ids as two fields, stems by source and length."""
    side = F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd")
    d = table(spark, sf_dir, "documents").select("source", F.concat(F.lit("text"), F.col("n_chars").cast("string")).alias("stem"), side.alias("side"))
    return diff.unpaired_stems(d, ["source"], "stem", "side", ("even", "odd"))


@query("""WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(greatest(-1.0, least(1.0, CAST(x AS DOUBLE))) * 127.5 + 127.5) AS INTEGER)) AS p FROM embeddings),
p AS (SELECT a.vec_id, unnest(a.p) AS x, unnest(b.p) AS y FROM q a JOIN q b ON b.vec_id = a.vec_id + 1)
SELECT vec_id AS image, count(*) AS compared, round(avg(CASE WHEN abs(x - y) >= 3 THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS changed, round(avg(CASE WHEN abs(x - y) > 3 THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS changed_more, max(abs(x - y)) AS largest FROM p GROUP BY 1""")
def pixel_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = lambda x: F.floor(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x.cast("double"))) * 127.5 + 127.5).cast("int")
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", level).alias("pixels"))
    base = v.select(F.col("vec_id").alias("image"), "pixels")
    out = diff.pixel_change(base, v.select((F.col("vec_id") - 1).alias("image"), "pixels"), "image", "pixels", 3)
    return out.select("image", "compared", rounded("changed").alias("changed"), rounded("changed_more").alias("changed_more"), "largest")


@query("""WITH e AS (SELECT user_id, ts, event_id, event_type, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM e), g AS (SELECT user_id, run, any_value(event_type) AS event_type, count(*) AS length FROM r GROUP BY ALL)
SELECT event_type, count(*) AS runs, max(length) AS longest FROM g GROUP BY 1""")
def richest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = diff.runs(table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"], "event_type")
    return r.groupBy("event_type").agg(F.count(F.lit(1)).alias("runs"), F.max("length").alias("longest"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round(abs(l_extendedprice - (l_extendedprice * (1 - l_discount) + l_extendedprice * l_discount - l_tax)), 6) + 0.0 AS gap,
abs(l_extendedprice - (l_extendedprice * (1 - l_discount) + l_extendedprice * l_discount - l_tax)) <= 1e-6 * abs(l_extendedprice) AS closed FROM lineitem""")
def split_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount"))).withColumn("off", F.col("l_extendedprice") * F.col("l_discount")).withColumn("rest", -F.col("l_tax"))
    return diff.split_closure(li, "l_extendedprice", ["net", "off", "rest"], 1e-6).select("l_orderkey", "l_linenumber", "l_partkey", rounded("gap").alias("gap"), "closed")


@query("""WITH s AS (SELECT s_nationkey, s_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL), f AS (SELECT *, v / sum(v) OVER (PARTITION BY s_nationkey) AS f FROM s)
SELECT s_nationkey, s_suppkey, round(f, 6) + 0.0 AS fraction, round(sum(f) OVER (PARTITION BY s_nationkey ORDER BY f DESC, s_suppkey ROWS UNBOUNDED PRECEDING), 6) + 0.0 AS cumulative FROM f""")
def energy_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.sum(money("l_extendedprice")).cast("double").alias("v"))
    s = per.join(table(spark, sf_dir, "supplier"), F.col("s_suppkey") == F.col("l_suppkey")).withColumn("fraction", F.col("v") / F.sum("v").over(Window.partitionBy("s_nationkey")))
    c = diff.energy_cumulative(s, ["s_nationkey"], [F.col("fraction").desc(), F.col("s_suppkey")], "fraction")
    return c.select("s_nationkey", "s_suppkey", rounded("fraction").alias("fraction"), rounded("cumulative").alias("cumulative"))


_RATE = "CASE lang WHEN 'en' THEN 4.0 ELSE 2.5 END"


def _ledger_rows(spark: SparkSession, sf_dir: str, capsule: Column | str = "source") -> DataFrame:
    d = table(spark, sf_dir, "documents").withColumn("source", F.col(capsule) if isinstance(capsule, str) else capsule)
    return ledger.measured(d.select("source", "lang", "text"), F.col("lang"), F.length("text").cast("bigint"), F.when(F.col("lang") == "en", 4.0).otherwise(2.5), F.col("lang") != "en")


@query(f"""WITH t AS (SELECT source, lang, length(text) AS c, CAST(round_even(length(text) / {_RATE}, 0) AS BIGINT) AS t FROM documents),
g AS (SELECT source, lang, CAST(count(*) AS BIGINT) AS files, CAST(sum(c) AS BIGINT) AS characters, CAST(sum(t) AS BIGINT) AS tokens, bool_or(lang <> 'en') AS estimated FROM t GROUP BY GROUPING SETS ((source, lang), (source)))
SELECT source, lang AS layer, files, characters, tokens, estimated, CASE WHEN tokens <= 0 THEN 0 ELSE CAST(round_even(tokens / pow(10, greatest(length(CAST(tokens AS VARCHAR)) - 2, 0)), 0) * pow(10, greatest(length(CAST(tokens AS VARCHAR)) - 2, 0)) AS BIGINT) END AS about, round(tokens / 200000.0, 6) + 0.0 AS budget_share FROM g""")
def token_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.ledger(_ledger_rows(spark, sf_dir), ["source"], 200_000).withColumn("budget_share", rounded("budget_share"))


_FILES = ", ".join(f"CAST(coalesce(sum(t) FILTER (WHERE capsule = 'ids_{k}'), 0) AS BIGINT) AS ids_{k}" for k in range(4))


@query(f"""WITH t AS (SELECT 'ids_' || (doc_id % 4) AS capsule, lang, CAST(round_even(length(text) / {_RATE}, 0) AS BIGINT) AS t FROM documents) SELECT lang AS layer, {_FILES} FROM t GROUP BY 1""")
def ledger_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as four capsules by the remainder of their id, languages as layers."""
    capsule = F.concat(F.lit("ids_"), F.pmod("doc_id", F.lit(4)).cast("string"))
    return ledger.ledger_pivot(_ledger_rows(spark, sf_dir, capsule), "source", [f"ids_{k}" for k in range(4)])


# --- documents -----------------------------------------------------------------------------------------------------


@query("SELECT event_id, key AS path, key AS name, json_extract_string(props, '$.' || key) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)")
def json_leaf_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_leaves(table(spark, sf_dir, "events"), ["event_id"], "props").drop("type")


@query("SELECT event_type, count(*) AS n, count(*) FILTER (WHERE json_valid(props)) AS valid FROM events GROUP BY 1")
def json_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count(F.try_parse_json("props")).alias("valid"))


@query("SELECT doc_id, length(text) - length(replace(replace(replace(text, chr(8211), ''), chr(8212), ''), chr(8722), '')) AS dashes, length(text) - length(replace(text, '|', '')) AS bars FROM documents")
def forbidden_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", text.forbidden_count(F.col("text")).alias("dashes"), text.forbidden_count(F.col("text"), "|").alias("bars"))


@query(r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g')) AS body FROM pages""")
def html_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.strip_tags(F.col("html")).alias("body"))


@query(r"SELECT page_id, regexp_replace(url, '(?i)\b(ref|utm_source)(\s*[:=]\s*)[^\s&|]+', '\1\2(redacted)', 'g') AS url FROM pages")
def redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.redact(F.col("url"), ["ref", "utm_source"]).alias("url"))


@query("""SELECT d.doc_id, 'not_empty' AS check_id, 'E' AS severity FROM documents d WHERE length(text) < 40
UNION ALL SELECT d.doc_id, 'bars', 'W' FROM documents d WHERE contains(text, ' | ')
UNION ALL SELECT d.doc_id, 'labelled_bad', 'E' FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE quality = 0
UNION ALL SELECT d.doc_id, 'unlabelled', 'W' FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def rule_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    # one scan: the label comes by a single join, and all rules are one array of findings per row
    rows = d.join(labels.groupBy("doc_id").agg(F.min("quality").alias("quality")), "doc_id", "left")
    rule = lambda test, name, severity: F.when(test, F.struct(F.lit(name).alias("check_id"), F.lit(severity).alias("severity")))
    found = F.array(rule(F.length("text") < 40, "not_empty", "E"), rule(F.contains("text", F.lit(" | ")), "bars", "W"), rule(F.col("quality") == 0, "labelled_bad", "E"), rule(F.col("quality").isNull(), "unlabelled", "W"))
    return rows.select("doc_id", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("f")).select("doc_id", "f.check_id", "f.severity")


_MESH = "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderkey % {0} = 0) AS DOUBLE) / nullif(count(*) FILTER (WHERE o_orderkey % {0} = 0), 0)"


@query(f"""WITH f AS (SELECT o_custkey % 40 AS quantity, {_MESH.format(2)} AS fine, {_MESH.format(3)} AS medium, {_MESH.format(5)} AS coarse FROM orders GROUP BY 1),
d AS (SELECT *, medium - fine AS d1, coarse - medium AS d2, greatest(fine, medium, coarse) - least(fine, medium, coarse) AS span FROM f),
o AS (SELECT *, CASE WHEN d1 * d2 < 0 THEN 'oscillatory' ELSE 'monotone' END AS behaviour, CASE WHEN d1 <> 0 AND d2 <> 0 THEN abs(ln(abs(d2 / d1))) / ln(2) * sign(abs(d2 / d1) - 1) END AS p FROM d),
s AS (SELECT *, CASE WHEN greatest(abs(d1), abs(d2)) <= 0 THEN 'nominal' WHEN p IS NULL OR NOT abs(d1) < abs(d2) THEN 'not_asymptotic' WHEN behaviour = 'oscillatory' THEN 'converged' WHEN p > 2.5 THEN 'above_order' WHEN p < 1.5 THEN 'reduced_order' ELSE 'converged' END AS status FROM o)
SELECT quantity, behaviour, status, round(p, 6) + 0.0 AS p, round(CASE WHEN behaviour = 'monotone' AND status IN ('converged', 'reduced_order') THEN fine - d1 / (pow(2, p) - 1) END, 3) + 0.0 AS extrapolated,
round(CASE WHEN status IN ('not_asymptotic', 'nominal') THEN NULL WHEN behaviour <> 'monotone' THEN abs(span / 2 / fine) WHEN status = 'above_order' THEN 3.0 * abs(d1 / fine) / 3 ELSE 1.25 * abs(d1 / fine) / (pow(2, p) - 1) END, 6) + 0.0 AS gci_fine FROM s""")
def richardson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean prices over a half, a third and a fifth of the orders as one quantity on three meshes."""
    part = lambda k: F.sum(F.when(F.col("o_orderkey") % k == 0, money("o_totalprice"))).cast("double") / F.nullif(F.count_if(F.col("o_orderkey") % k == 0), F.lit(0))
    f = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 40).alias("quantity")).agg(part(2).alias("fine"), part(3).alias("medium"), part(5).alias("coarse"))
    d = modal.discretization(f, ["quantity"], "fine", "medium", "coarse", 2.0)
    return d.select("quantity", "behaviour", "status", rounded("p").alias("p"), rounded("extrapolated", 3).alias("extrapolated"), rounded("gci_fine").alias("gci_fine"))


@query("SELECT l_returnflag, round(regr_intercept(l_extendedprice, l_quantity), 3) + 0.0 AS extrapolated FROM lineitem GROUP BY 1")
def linear_extrapolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = modal.linear_extrapolation(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice")
    return out.withColumn("extrapolated", rounded("extrapolated", 3))


@query("""WITH RECURSIVE p AS (SELECT s_suppkey AS id, s_nationkey AS g, s_acctbal AS x FROM supplier), e AS (SELECT a.id AS u, b.id AS v FROM p a JOIN p b ON a.g = b.g AND abs(a.x - b.x) <= 300),
r AS (SELECT id AS node, id AS reach FROM p UNION SELECT r.node, e.v FROM r JOIN e ON e.u = r.reach)
SELECT node AS s_suppkey, min(reach) AS cluster FROM r GROUP BY node""")
def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators.graph import proximity_roots

    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", F.col("s_acctbal").alias("x"), F.lit(0.0).alias("y"))
    return proximity_roots(s, ["s_nationkey"], "s_suppkey", "x", "y", 300.0).select("s_suppkey", F.col("root").alias("cluster"))


@query()
def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of a nation as clusters that move from month to month with their revenue, and compete for the tracks."""
    m = _monthly(spark, sf_dir).join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    station = (F.year("m") * 12 + F.month("m")) / 10
    mean = m.groupBy("s_nationkey").agg(F.avg("q").alias("_mean"))
    c = m.join(mean, "s_nationkey").select(
        "s_nationkey", station.alias("x"), (F.col("q") / F.col("_mean") / 10).alias("y"), (F.col("s_suppkey") % 3 / 20).alias("z"),
        F.when(F.col("s_suppkey") % 2 == 0, 1).otherwise(-1).alias("sense"), F.round(F.col("q") / 1000).alias("circulation"),
    )
    return features.track_links(c, ["s_nationkey"])


@query(r"""WITH b AS (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g')) AS body FROM pages),
t AS (SELECT page_id, list_filter(regexp_split_to_array(body, '[.,] '), lambda x: x <> '') AS l FROM b)
SELECT page_id, len(l)::BIGINT + 1 AS lines, sha256('page' || chr(10) || array_to_string(list_transform(l, lambda x: '  ' || x), chr(10))) AS digest FROM t""")
def text_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's visible lines, written in the compact form and decoded again."""
    lines = F.concat(F.lit("page\n"), F.array_join(F.transform(F.filter(F.split(text.strip_tags(F.col("html")), r"[.,] "), lambda s: s != ""), lambda s: F.concat(F.lit("  "), s)), "\n"))
    coded = text.encode_column(table(spark, sf_dir, "pages").select("page_id", lines.alias("text"))).select("page_id", F.col("result").alias("text"))
    back = text.decode_column(coded)
    return back.select("page_id", F.size(F.split("result", "\n")).cast("bigint").alias("lines"), F.sha2("result", 256).alias("digest"))


@query("""SELECT event_id, '{' || chr(10) || '  "version": 2,' || chr(10) || '  "key_number": ' || json_extract_string(props, '$.k') || chr(10) || '}' || chr(10) AS migrated, 3 AS changes, 0 AS problems FROM events""")
def json_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.operators.migrate import migrate_column

    edits = {"": [("rename", "k", "key_number"), ("set", "version", 2), ("order", "", ["version"])]}
    return migrate_column(table(spark, sf_dir, "events").select("event_id", "props"), "props", edits).select("event_id", "migrated", F.size("changes").alias("changes"), F.size("problems").alias("problems"))


@query()
def pod_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly revenue per supplier as snapshots: modes over suppliers."""
    m = _monthly(spark, sf_dir).groupBy("l_suppkey", F.year("m").alias("step")).agg((F.sum("q") / 1e6).alias("u"))
    return modal.pod(m, "l_suppkey", "step", ["u"])[1]


@query(f"""WITH {_E} SELECT w.event_type AS run, w.win AS window_no, w.n, round(w.mean, 6) + 0.0 AS mean, round(w.sd, 6) + 0.0 AS sd, w.cycles, CASE WHEN w.win = dec.win THEN dec.status ELSE 'running' END AS status
FROM w JOIN dec ON w.event_type = dec.event_type AND (dec.win IS NULL OR w.win <= dec.win)""")
def streaming_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window gate over the events as a stream of micro-batches."""
    import uuid

    from tidemark.streaming.gate import streaming_gate as gate

    e = _events(spark, sf_dir).select(F.col("event_type").alias("run"), F.col("i").cast("bigint").alias("i"), "value")
    base = shared_base(spark)
    root = f"{base.rstrip('/')}/tidemark/stream-{uuid.uuid4().hex}"
    e.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(e.schema).parquet(f"{root}/in")
    q = gate(stream, SIZE).writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    out = spark.read.schema("run string, window bigint, n bigint, mean double, sd double, cycles bigint, status string").parquet(f"{root}/out")
    return out.withColumn("mean", rounded("mean")).withColumn("sd", rounded("sd")).withColumnRenamed("window", "window_no")


_SIGNALS = "(event_id % 4) || '/' || event_type"


@query(f"""WITH {_E.replace('event_id, value, row_number', f'event_id, {_SHAPES} AS value, row_number', 1).replace('SELECT event_type, ts', f'SELECT {_SIGNALS} AS event_type, ts', 1).replace('PARTITION BY event_type ORDER BY ts', f'PARTITION BY {_SIGNALS} ORDER BY ts', 1)},
kinds AS (SELECT count(DISTINCT event_type) AS k FROM events),
per AS (SELECT split_part(event_type, '/', 1) AS run, win, bool_and(sd <= 1e-4 * greatest(abs(mean), 1)) AS calm, count(*) AS n FROM w GROUP BY ALL HAVING count(*) = (SELECT k FROM kinds)),
gs AS (SELECT split_part(event_type, '/', 1) AS run, win, bool_and(passed) AS passed FROM gp GROUP BY ALL),
r AS (SELECT per.run, per.win, CASE WHEN calm THEN 'converged' WHEN coalesce(passed, false) THEN 'stationary' WHEN per.win + 1 >= 7 THEN 'no_steady_state' ELSE 'running' END AS status FROM per LEFT JOIN gs ON per.run = gs.run AND per.win = gs.win),
stop AS (SELECT run, min(win) AS last FROM r WHERE status <> 'running' GROUP BY 1)
SELECT r.run, r.win AS window_no, (r.win + 1) * 50 - 1 AS stopped_at, status FROM r LEFT JOIN stop ON r.run = stop.run WHERE last IS NULL OR r.win <= last""")
def streaming_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as a stream of four runs, of which the event types are the signals: a verdict needs all of them."""
    import uuid

    from tidemark.streaming.gate import STORE, signals_gate

    k = F.col("event_id") % 4
    shaped = F.when(k == 0, 5 + F.col("value") * 1e-9).when(k == 1, F.col("value") + F.col("event_id")).when(k == 2, F.col("value")).otherwise(F.col("value") * (1 + F.col("user_id") % 2 * 4))
    e = table(spark, sf_dir, "events").select(k.cast("string").alias("run"), F.col("event_type").alias("signal"), "ts", "event_id", shaped.alias("value"))
    names = [r[0] for r in e.select("signal").distinct().collect()]  # the kinds of signals, a handful by nature
    e = numbered(e, ["run", "signal"], ["ts", "event_id"], F.date_trunc("day", "ts")).select("run", "signal", F.col("i").cast("bigint").alias("i"), "value")
    root = f"{shared_base(spark).rstrip('/')}/tidemark/stream-{uuid.uuid4().hex}"
    e.write.parquet(f"{root}/in")
    before = spark.conf.get(STORE[0])
    spark.conf.set(*STORE)
    try:
        stream = spark.readStream.schema(e.schema).option("maxBytesPerTrigger", 256 << 20).parquet(f"{root}/in")
        sink = signals_gate(stream, SIZE, names).writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state")
        sink.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(STORE[0], before)
    out = spark.read.schema("run string, window bigint, at bigint, status string").parquet(f"{root}/out")
    return out.withColumnsRenamed({"window": "window_no", "at": "stopped_at"})


@query("SELECT source, CAST(round_even(length(text) / 2.5, 0) AS BIGINT) AS tokens, doc_id FROM documents")
def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("source", tokens_of(F.length("text")).alias("tokens"), "doc_id")


# --- allow-lists, sets, balances -----------------------------------------------------------------------------------


@query("SELECT station, count(*) AS n FROM lineitem, (SELECT CAST(unnest([0.02, 0.04, 0.06]) AS DOUBLE) AS station) WHERE abs(l_discount - station) <= 0.01 + 1e-12 GROUP BY 1")
def station_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.station_bin(table(spark, sf_dir, "lineitem"), [0.02, 0.04, 0.06], 0.02 + 2e-12, "l_discount").groupBy("station").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH p AS (SELECT *, 0.1 * max(abs(c_acctbal)) OVER (PARTITION BY c_mktsegment) AS p FROM customer), l AS (SELECT *, CASE WHEN c_acctbal > p THEN 'positive' WHEN c_acctbal < -p THEN 'negative' END AS lobe FROM p)
SELECT c_mktsegment, lobe, count(*) AS n, round(sum(abs(c_acctbal) * c_nationkey) / sum(abs(c_acctbal)), 6) + 0.0 AS y_mean FROM l WHERE lobe IS NOT NULL GROUP BY ALL""")
def lobes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = features.lobes(table(spark, sf_dir, "customer"), ["c_mktsegment"], "c_acctbal", "c_nationkey", "c_custkey")
    return c.select("c_mktsegment", "lobe", "n", rounded("y_mean").alias("y_mean"))


@query("SELECT c_mktsegment, round(CAST(sum(CASE WHEN c_nationkey < 12 THEN CAST(c_acctbal AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) / CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE), 6) + 0.0 AS coverage FROM customer GROUP BY 1")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.coverage(table(spark, sf_dir, "customer"), ["c_mktsegment"], F.col("c_nationkey") < 12, "c_acctbal").withColumn("coverage", rounded("coverage"))


@query("""WITH n AS (SELECT n_regionkey, n_nationkey % 2 AS side, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS v FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_regionkey, n_nationkey),
r AS (SELECT *, row_number() OVER (PARTITION BY n_regionkey, side ORDER BY v DESC) AS r FROM n), t AS (SELECT n_regionkey, side, max(v) AS first, sum(v) AS two, count(*) AS n FROM r WHERE r <= 2 GROUP BY ALL)
SELECT n_regionkey, round(max(first), 2) + 0.0 AS high, round(arg_min(two, first), 2) + 0.0 AS low_two, arg_min(n, first) = 2 AND abs(arg_min(two, first) - max(first)) <= 0.2 * max(first) AS split FROM t GROUP BY 1""")
def split_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.sum(money("c_acctbal")).cast("double").alias("v"))
    n = table(spark, sf_dir, "nation").join(per, F.col("n_nationkey") == F.col("c_nationkey")).withColumn("side", F.col("n_nationkey") % 2)
    return features.split_verdict(n, ["n_regionkey"], "side", "v", 0.2).select("n_regionkey", rounded("high", 2).alias("high"), rounded("low_two", 2).alias("low_two"), "split")


@query("SELECT l_returnflag, round(-1 / regr_slope(ln(l_extendedprice), l_quantity), 4) + 0.0 AS steps_per_fold FROM lineitem WHERE l_extendedprice <> 0 GROUP BY 1")
def decay_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modal.decay_fit(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice").withColumn("steps_per_fold", rounded("steps_per_fold", 4))


@query("""WITH a AS (SELECT l_returnflag, l_quantity AS x, avg(l_extendedprice) AS y FROM lineitem GROUP BY ALL), l AS (SELECT l_returnflag, max(x) AS x0, arg_max(y, x) AS y0 FROM a WHERE x <= 10.5 GROUP BY 1), h AS (SELECT l_returnflag, min(x) AS x1, arg_min(y, x) AS y1 FROM a WHERE x >= 10.5 GROUP BY 1)
SELECT l_returnflag, round(y0 + (ln(10.5) - ln(x0)) / (ln(x1) - ln(x0)) * (y1 - y0), 3) + 0.0 AS value FROM l JOIN h USING (l_returnflag)""")
def log_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", F.col("l_quantity").alias("x")).agg(F.avg("l_extendedprice").alias("y"))
    return modal.log_interpolation(a, ["l_returnflag"], "x", "y", 10.5).withColumn("value", rounded("value", 3))


@query("SELECT c_nationkey, round(sum(c_acctbal), 2) + 0.0 AS net, round(sum(greatest(c_acctbal, 0)), 2) + 0.0 AS inflow, round(CASE WHEN sum(greatest(c_acctbal, 0)) > 0 THEN sum(c_acctbal) / sum(greatest(c_acctbal, 0)) END, 6) + 0.0 AS imbalance FROM customer GROUP BY 1")
def mass_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = accounts.mass_balance(table(spark, sf_dir, "customer"), ["c_nationkey"], "c_acctbal")
    return m.select("c_nationkey", rounded("net", 2).alias("net"), rounded("inflow", 2).alias("inflow"), rounded("imbalance").alias("imbalance"))


@query("SELECT l_returnflag, threshold, count(*) FILTER (WHERE l_extendedprice >= threshold) AS n FROM lineitem, (SELECT CAST(unnest([1000, 10000, 50000, 1000000]) AS DOUBLE) AS threshold) GROUP BY ALL")
def threshold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounts.threshold_counts(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", [1000, 10000, 50000, 1000000])


_CLASS = "CASE WHEN regexp_matches(p_name, '^small') THEN 'owned' WHEN regexp_matches(p_brand, 'x') AND p_size > 25 THEN 'inherited' WHEN regexp_matches(p_name, 'ring$|bolt$') AND p_size > 25 THEN 'inherited' WHEN regexp_matches(p_name, 'ring$|bolt$') THEN 'inherited_unused' WHEN regexp_matches(p_name, '^red') THEN 'system' WHEN p_size > 25 THEN 'unlisted' ELSE 'unknown' END"


@query(f"""WITH o AS (SELECT p_type, {_CLASS} AS class FROM part), v AS (SELECT p_type, NOT bool_or(class IN ('unlisted', 'unknown')) AS passed FROM o GROUP BY 1) SELECT o.p_type, class, count(*) AS n, any_value(passed) AS passed FROM o JOIN v USING (p_type) GROUP BY ALL""")
def object_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = accounts.classify_objects(table(spark, sf_dir, "part"), "p_name", ["^small"], ["ring$", "bolt$"], ["^red"], F.col("p_size") > 25)
    return accounts.object_counts(o, ["p_type"])


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)")
def missing_owned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounts.missing_owned(table(spark, sf_dir, "events"), "user_id", table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")


@query("SELECT page_id, url FROM pages WHERE NOT (regexp_matches(url, '^https://') OR regexp_matches(url, 'page=2'))")
def undeclared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounts.undeclared(table(spark, sf_dir, "pages").select("page_id", "url"), "url", ["^https://", "page=2"])


@query("SELECT a.o_orderkey, b.o_totalprice AS base_value FROM orders a LEFT JOIN orders b ON b.o_orderkey = a.o_orderkey // 2 - 5")
def base_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", (F.floor(F.col("o_orderkey") / 2) - 5).alias("base"))
    return accounts.base_lookup(o, "o_orderkey", "base", "o_totalprice").select("o_orderkey", "base_value")


_T = "round(epoch_us(ts) / 6e7, 0)"


@query(f"WITH e AS (SELECT event_id, event_type, user_id, {_T} AS m FROM events) SELECT a.event_id, b.event_id AS r_event_id FROM e a JOIN e b ON a.m = b.m WHERE a.event_type = 'click' AND b.event_type = 'view'")
def time_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "event_type", (F.unix_micros(F.col("ts").cast("timestamp")) / 6e7).alias("m"))
    out = accounts.time_align(e.filter("event_type = 'click'"), e.filter("event_type = 'view'").drop("event_type"), "m", 0)
    return out.select("event_id", "r_event_id")


@query("SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1")
def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounts.duplicates(table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day")), ["o_custkey", "day"])


@query("""WITH m AS (SELECT n_regionkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) AS r, count(*) OVER (PARTITION BY n_regionkey) AS n FROM nation)
SELECT n_regionkey, string_agg(n_name, '; ' ORDER BY n_name) FILTER (WHERE r <= 4) || CASE WHEN max(n) > 4 THEN ' (+' || (max(n) - 4) || ' more)' ELSE '' END AS message FROM m GROUP BY 1""")
def first_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounts.first_messages(table(spark, sf_dir, "nation"), ["n_regionkey"], "n_name")


@query(f"{_MIRROR} SELECT (SELECT count(*) FROM c) AS cells, count(*) AS queried, (SELECT count(*) FROM c) - count(*) AS on_plane, count(*) FILTER (WHERE outcome = 'paired') AS paired, count(*) FILTER (WHERE outcome = 'level_mismatch') AS level_mismatch, count(*) FILTER (WHERE outcome = 'unpaired') AS unpaired FROM m")
def mirror_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, pairs = _mirror(spark, sf_dir)
    return neighbours.outcome_counts(pairs, c.count())


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS i FROM lineitem) WHERE i % 50 = 0 AND i < 50 * 200")
def stride_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the first 200 strides only need the 10,000 smallest keys, a top-k
    few = table(spark, sf_dir, "lineitem").select(*_KEYS).orderBy(*_KEYS).limit(50 * 200)
    return sample.stride_sample(few, 50, 200, _KEYS)


from tidemark import bindings_artifacts, bindings_files, bindings_more, bindings_trees  # noqa: E402, F401  (register further queries)
