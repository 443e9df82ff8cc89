"""Aggregates behind charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.operators import chartdata as ch
from larkspur.operators import columns as co
from larkspur.plans.registry import query


@query("C1", sql="""
    WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
    c AS (SELECT least(CAST(floor((o_totalprice - lo) / ((hi - lo) / 20)) AS INTEGER), 19) AS bin, count(*) AS n FROM orders, r GROUP BY 1)
    SELECT CAST(k AS INTEGER) AS bin, round(lo + k * ((hi - lo) / 20), 4) AS start, round(lo + (k + 1) * ((hi - lo) / 20), 4) AS stop,
      coalesce(n, 0) AS count FROM range(20) AS g(k) CROSS JOIN r LEFT JOIN c ON bin = k""")
def amount_histogram(t):
    return co.round_columns(ch.histogram(t.orders, "o_totalprice", 20), 4)


@query("C2", sql="""
    SELECT floor(l_extendedprice / 5000.0::DOUBLE) * 5000 AS start, count(*) AS count FROM lineitem GROUP BY 1""")
def price_histogram(t):
    return ch.histogram_width(t.lineitem, "l_extendedprice", 5000)


@query("C3", sql="""
    WITH r AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)
    SELECT l_returnflag, least(CAST(floor((l_quantity - lo) / ((hi - lo) / 10)) AS INTEGER), 9) AS bin, count(*) AS count
    FROM lineitem, r GROUP BY 1, 2""")
def quantity_histogram_by_flag(t):
    return ch.histogram(t.lineitem, "l_quantity", 10, ["l_returnflag"]).select("l_returnflag", "bin", "count")


@query("C4", sql="""
    WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
               FROM events GROUP BY 1),
    m AS (SELECT *, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM events JOIN q USING (event_type))
    SELECT event_type, round(min(q1), 6) AS q1, round(min(median), 6) AS median, round(min(q3), 6) AS q3,
      min(value) FILTER (inside) AS whisker_low, max(value) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS outliers
    FROM m GROUP BY 1""")
def event_value_boxes(t):
    return co.round_columns(ch.box_summary(t.events, "value", ["event_type"]), 6, ["q1", "median", "q3"])


@query("C4", sql="""
    WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
    SELECT event_id, event_type, value FROM events JOIN q USING (event_type)
    WHERE NOT value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
def event_value_outliers(t):
    return ch.box_outliers(t.events.select("event_id", "event_type", "value"), "value", ["event_type"])


@query("C5", sql="""
    SELECT p_type, round(avg(p_retailprice), 6) AS value FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""")
def priciest_type_bars(t):
    return ch.bars(t.part, "p_type", F.round(F.avg("p_retailprice"), 6), 3)


@query("C5", sql="""
    SELECT CAST(list_position(['HOUSEHOLD', 'BUILDING', 'MACHINERY', 'AUTOMOBILE', 'FURNITURE'], c_mktsegment) AS BIGINT) AS rank,
      c_mktsegment, count(*) AS value FROM customer GROUP BY 1, 2 ORDER BY 1""")
def segment_bars_in_order(t):
    order = ["HOUSEHOLD", "BUILDING", "MACHINERY", "AUTOMOBILE", "FURNITURE"]
    return ch.bars_in_order(t.customer, "c_mktsegment", F.count(F.lit(1)), order)


@query("C6", sql="SELECT p_size, p_brand, count(*) AS count FROM part GROUP BY 1, 2")
def size_brand_bubbles(t):
    return ch.bubbles(t.part, "p_size", "p_brand")


@query("C7", sql="SELECT event_type, round(avg(value), 6) AS mean FROM events GROUP BY 1")
def event_mean_marks(t):
    return co.round_columns(ch.group_mean_marks(t.events, "event_type", "value"), 6)


@query("C8", sql="""
    SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
      round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept, min(l_quantity) AS x_min, max(l_quantity) AS x_max
    FROM lineitem WHERE l_quantity > 10 AND l_discount > 0.01 GROUP BY 1""")
def price_lines_by_flag(t):
    chosen = t.lineitem.where("l_quantity > 10 AND l_discount > 0.01")
    line = ch.straight_line(chosen, "l_quantity", "l_extendedprice", ["l_returnflag"])
    return co.round_columns(co.round_columns(line, 4, ["slope"]), 3, ["intercept"])


@query("C9", sql="""
    WITH s AS (SELECT count(*)::DOUBLE AS n, min(value) AS lo, max(value) - min(value) AS span,
                 stddev_samp(value) * pow(count(*)::DOUBLE, -0.2) AS h FROM events),
    v AS (SELECT value AS x, count(*) AS w FROM events GROUP BY 1)
    SELECT CAST(k AS INTEGER) AS k, round(lo - 0.5 * span + k * (2 * span / 49), 6) AS x,
      round(sum(w * exp(-0.5 * pow((v.x - (lo - 0.5 * span + k * (2 * span / 49))) / h, 2))) / (min(n) * min(h) * sqrt(2 * pi())), 8) AS density
    FROM v, s, range(50) AS g(k) GROUP BY k, lo, span""")
def event_value_density(t):
    curve = ch.density(t.events, "value", 50)
    return curve.select("k", F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


@query("C9", sql="""
    WITH s AS (SELECT count(*)::DOUBLE AS n, min(value) AS lo, max(value) - min(value) AS span,
                 stddev_samp(value) * pow(count(*)::DOUBLE, -0.2) AS h FROM events),
    u AS (SELECT (value - lo) * 50 / h AS u FROM events, s),
    b AS (SELECT floor(u) AS b, count(*) AS n, sum(u - floor(u)) AS r FROM u GROUP BY 1),
    v AS (SELECT lo + b * h / 50 AS x, b.n - r AS w FROM b, s UNION ALL SELECT lo + (b + 1) * h / 50, r FROM b, s)
    SELECT CAST(k AS INTEGER) AS k, round(lo - 0.5 * span + k * (2 * span / 99), 6) AS x,
      round(sum(w * exp(-0.5 * pow((v.x - (lo - 0.5 * span + k * (2 * span / 99))) / h, 2))) / (min(n) * min(h) * sqrt(2 * pi())), 8) AS density
    FROM v, s, range(100) AS g(k) GROUP BY k, lo, span""")
def event_value_binned_density(t):
    curve = ch.binned_density(t.events, "value", 100)
    return curve.select("k", F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


@query("C10", sql="""
    SELECT n_name, round(sum(s_acctbal), 2) AS value FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""")
def supplier_balance_map(t):
    per_key = ch.value_per_region(t.supplier, "s_nationkey", "s_acctbal")
    named = per_key.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return named.select("n_name", F.round("value", 2).alias("value"))
