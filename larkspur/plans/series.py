"""Window steps and diagnostics of weekly and daily series."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions.dates import iso_text
from larkspur.functions.distributions import normal_share_sql
from larkspur.operators import columns as co
from larkspur.operators import joins as jo
from larkspur.operators import repair as rp
from larkspur.plans.calendar import SUNDAY, WEEKLY_SQL
from larkspur.plans.registry import query
from larkspur.series import arima as ar
from larkspur.series import diagnostics as dg
from larkspur.series import prep as sp


def weekly_orders(t):
    """(ds, y): order amount per Sunday-labelled week, to the cent."""
    weekly = sp.regular(t.orders, "o_orderdate", "o_totalprice", "week_sunday")
    return weekly.withColumn("y", F.round("y", 2))


def weekly_by_priority(t):
    weekly = sp.regular(t.orders, "o_orderdate", "o_totalprice", "week_sunday", ["o_orderpriority"])
    return weekly.withColumn("y", F.round("y", 2))


def _polynomial(weights, x: str) -> str:
    return " + ".join(f"{w} * pow({x}, {i})" for i, w in enumerate(weights))


def _dated(df):
    return df.withColumn("ds", iso_text(F.col("ds")))


@query("Y1", "D7", "D8", sql="""
    SELECT event_type, CAST(ts AS DATE)::VARCHAR AS ds, round(avg(value), 6) AS y FROM events GROUP BY 1, 2""")
def prepared_event_series(t):
    return _dated(co.round_columns(sp.prepare(t.events, "ts", "value", ["event_type"]), 6))


@query("W1", sql="""
    WITH d AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, count(*) AS count FROM orders GROUP BY 1, 2)
    SELECT o_orderpriority, day::VARCHAR AS day, count,
      CAST(sum(count) OVER (PARTITION BY o_orderpriority ORDER BY day) AS BIGINT) AS running FROM d""")
def running_orders_per_priority(t):
    running = sp.running_count(t.orders, "o_orderpriority", "o_orderdate")
    return running.select("o_orderpriority", iso_text(F.col("o_orderdate")).alias("day"), "count", "running")


@query("W2", "W3", sql=f"""
    SELECT ds::VARCHAR AS ds, y, round(y - lag(y) OVER (ORDER BY ds), 2) AS step, round(y - lag(y, 52) OVER (ORDER BY ds), 2) AS yearly
    FROM {WEEKLY_SQL}""")
def weekly_differences(t):
    stepped = sp.difference(sp.difference(weekly_orders(t), "y", 1, name="step"), "y", 52, name="yearly")
    return _dated(co.round_columns(stepped, 2))


@query("W4", "N8", sql=f"""
    WITH g AS (SELECT ds, CASE WHEN month(ds) IN (3, 7) OR day(ds) = 9 THEN NULL ELSE y END AS y FROM {WEEKLY_SQL}),
    n AS (SELECT ds, y, last_value(y IGNORE NULLS) OVER (ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
            lead(y) OVER (ORDER BY ds) AS a FROM g)
    SELECT ds::VARCHAR AS ds, coalesce(y, (b + a) / 2, b, a) AS y FROM n""")
def weekly_gaps_filled(t):
    gone = F.month("ds").isin(3, 7) | (F.dayofmonth("ds") == 9)
    gaps = weekly_orders(t).withColumn("y", F.when(~gone, F.col("y")))
    return _dated(rp.fill_neighbour_mean(gaps, "y", "ds"))


@query("W4", sql=f"""
    SELECT ds::VARCHAR AS ds, y, lag(y) OVER (ORDER BY ds) AS before, lead(y) OVER (ORDER BY ds) AS after FROM {WEEKLY_SQL}""")
def weekly_neighbours(t):
    return _dated(sp.neighbours(weekly_orders(t)))


@query("Y7", "Y14", sql=f"""
    WITH f AS (SELECT ds, y, lag(y) OVER w + lag(y, 52) OVER w - lag(y, 53) OVER w AS fitted FROM {WEEKLY_SQL} WINDOW w AS (ORDER BY ds))
    SELECT ds::VARCHAR AS ds, y, round(fitted, 2) AS fitted, round(y - fitted, 2) AS resid FROM f""")
def weekly_seasonal_walk(t):
    return _dated(co.round_columns(ar.seasonal_walk(weekly_orders(t), 52), 2))


@query("Y9", sql=f"""
    WITH f AS (SELECT ds, y - (lag(y) OVER w + lag(y, 52) OVER w - lag(y, 53) OVER w) AS e FROM {WEEKLY_SQL} WINDOW w AS (ORDER BY ds)),
    d AS (SELECT e, e - lag(e) OVER (ORDER BY ds) AS s FROM f WHERE e IS NOT NULL)
    SELECT round(sum(s * s) / sum(e * e), 6) AS durbin_watson FROM d""")
def weekly_walk_watson(t):
    return co.round_columns(dg.durbin_watson(ar.seasonal_walk(weekly_orders(t), 52)), 6)


PAIRED_SQL = f"""(WITH g AS (SELECT CAST(date_trunc('week', l_shipdate) AS DATE) - 1 AS ds, round(sum(l_extendedprice), 2) AS x
      FROM lineitem GROUP BY 1),
    w AS (SELECT CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 7 DAY)) AS DATE) AS ds FROM g)
    SELECT o.ds, o.y, s.x FROM {WEEKLY_SQL} o LEFT JOIN (SELECT ds, coalesce(x, 0) AS x FROM w LEFT JOIN g USING (ds)) s ON o.ds = s.ds)"""


def paired_weeks(t):
    """Weekly order amounts next to weekly shipments, whose Mondays are shifted to the Sunday before."""
    shipped = sp.regular(t.lineitem, "l_shipdate", "l_extendedprice", "week_monday")
    shifted = shipped.select(F.date_sub("ds", 1).alias("ds"), F.round("y", 2).alias("x"))
    return jo.align(weekly_orders(t), shifted, "ds", "x")


@query("J4", "J5", "D9", "D13", sql=f"SELECT ds::VARCHAR AS ds, y, x FROM {PAIRED_SQL}")
def orders_next_to_shipments(t):
    return _dated(paired_weeks(t))


@query("Y18", "A15", "W2", sql=f"""
    WITH d AS (SELECT y, x, y - lag(y) OVER (ORDER BY ds) AS dy, x - lag(x) OVER (ORDER BY ds) AS dx FROM {PAIRED_SQL})
    SELECT round(corr(y, x), 6) AS levels, round(corr(dy, dx), 6) AS differences FROM d""")
def orders_shipments_correlation(t):
    return co.round_columns(sp.paired_correlation(paired_weeks(t), "y", "x"), 6)


ACF_SQL = f"""
    WITH e AS (SELECT ds, y - avg(y) OVER () AS e FROM {WEEKLY_SQL}),
    n AS (SELECT e, row_number() OVER (ORDER BY ds) AS i FROM e)
    SELECT CAST(k AS INTEGER) AS lag, sum(a.e * b.e) / (SELECT sum(e * e) FROM n) AS acf
    FROM range(54) AS r(k) JOIN n a ON true JOIN n b ON a.i - k = b.i GROUP BY k"""


@query("Y3", sql=f"SELECT lag, round(acf, 6) AS acf FROM ({ACF_SQL})")
def weekly_autocorrelation(t):
    return co.round_columns(dg.autocorrelation(weekly_orders(t), 53), 6)


@query("Y4", sql=f"""
    WITH a AS (SELECT max(acf) FILTER (lag = 1) AS r1, max(acf) FILTER (lag = 2) AS r2, max(acf) FILTER (lag = 3) AS r3, max(acf) FILTER (lag = 4) AS r4 FROM ({ACF_SQL})),
    b AS (SELECT *, (r2 - r1 * r1) / (1 - r1 * r1) AS p22 FROM a), c AS (SELECT *, r1 * (1 - p22) AS p21 FROM b),
    d AS (SELECT *, (r3 - p21 * r2 - p22 * r1) / (1 - p21 * r1 - p22 * r2) AS p33 FROM c),
    e AS (SELECT *, p21 - p33 * p22 AS p31, p22 - p33 * p21 AS p32 FROM d),
    f AS (SELECT *, (r4 - p31 * r3 - p32 * r2 - p33 * r1) / (1 - p31 * r1 - p32 * r2 - p33 * r3) AS p44 FROM e)
    SELECT CAST(0 AS INTEGER) AS lag, 1.0::DOUBLE AS pacf UNION ALL SELECT 1, round(r1, 6) FROM f UNION ALL SELECT 2, round(p22, 6) FROM f
    UNION ALL SELECT 3, round(p33, 6) FROM f UNION ALL SELECT 4, round(p44, 6) FROM f""")
def weekly_partial_autocorrelation(t):
    return co.round_columns(dg.partial_autocorrelation(weekly_orders(t), 4), 6)


@query("Y4")
def partial_autocorrelation_by_priority(t):
    return co.round_columns(dg.partial_autocorrelation(weekly_by_priority(t), 52, by=["o_orderpriority"]), 6)


@query("Y2", sql=f"""
    WITH d AS (SELECT y - lag(y) OVER (ORDER BY ds) AS dy, lag(y) OVER (ORDER BY ds) AS l FROM {WEEKLY_SQL}),
    f AS (SELECT count(*) AS n, regr_slope(dy, l) AS b, regr_syy(dy, l) * (1 - regr_r2(dy, l)) / (count(*) - 2) AS s2, regr_sxx(dy, l) AS sxx
          FROM d WHERE dy IS NOT NULL),
    z AS (SELECT *, CASE WHEN b / sqrt(s2 / sxx) <= {dg.P_VALUE_SWITCH} THEN {_polynomial(dg.P_VALUE_SMALL, "b / sqrt(s2 / sxx)")}
          ELSE {_polynomial(dg.P_VALUE_LARGE, "b / sqrt(s2 / sxx)")} END AS z FROM f)
    SELECT round(b / sqrt(s2 / sxx), 4) AS statistic, 0 AS lags, n AS n_obs,
      round(CASE WHEN b / sqrt(s2 / sxx) > {dg.P_VALUE_HIGH} THEN 1 WHEN b / sqrt(s2 / sxx) < {dg.P_VALUE_LOW} THEN 0 ELSE {normal_share_sql("greatest(-9.0, z)")} END, 8) AS p_value,
      round(-2.86154 - 2.8903 / n - 4.234 / (n * n) - 40.040 / (n * n * n), 6) AS critical_5 FROM z""")
def weekly_unit_root_plain(t):
    row = dg.unit_root_test(weekly_orders(t), lag=0)
    return row.select(
        F.round("statistic", 4).alias("statistic"), "lags", "n_obs", F.round("p_value", 8).alias("p_value"), F.round("critical_5", 6).alias("critical_5")
    )


@query("Y2")
def unit_root_by_priority(t):
    return co.round_columns(dg.unit_root_test(weekly_by_priority(t), by=["o_orderpriority"]), 6)
