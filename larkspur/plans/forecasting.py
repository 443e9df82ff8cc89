"""Fitted series models on the weekly order amounts."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from larkspur.functions.dates import iso_text
from larkspur.operators import calendar as ca
from larkspur.operators import columns as co
from larkspur.plans.calendar import WEEKLY_BY_SQL
from larkspur.plans.registry import query
from larkspur.plans.series import paired_weeks, weekly_by_priority, weekly_orders
from larkspur.series import arima as ar
from larkspur.series import diagnostics as dg
from larkspur.series import prep as sp
from larkspur.series import trend as tr

BY = ["o_orderpriority"]


def _dated(df):
    return df.withColumn("ds", iso_text(F.col("ds")))


@query("Y5", "Y10", "Y19")
def arima_coefficients(t):
    model = ar.fit(weekly_by_priority(t), ar.Order(2, 1, 1), BY)
    return co.round_columns(model.interval_table(), 6)


@query("Y5", "Y10")
def arima_forecast(t):
    model = ar.fit(weekly_by_priority(t), ar.Order(5, 1, 3), BY)
    ahead = ar.forecast(model, 53, 7).withColumn("y", F.lit(None).cast("double"))
    past = model.history.select(*BY, "ds", F.col("fitted").alias("yhat"), "y")
    return _dated(co.round_columns(past.unionByName(ahead), 2))


@query("Y6", "Y10")
def seasonal_arima_forecast(t):
    order = ar.Order(3, 1, 3, 1, 1, 1, 52, trend=True)
    return _dated(co.round_columns(ar.forecast(ar.fit(weekly_by_priority(t), order, BY), 53, 7), 2))


@query("Y5", "Y19", sql=f"""
    WITH d AS (SELECT o_orderpriority, ds, y - lag(y) OVER (PARTITION BY o_orderpriority ORDER BY ds) AS w FROM {WEEKLY_BY_SQL}),
    l AS (SELECT o_orderpriority, w, lag(w) OVER (PARTITION BY o_orderpriority ORDER BY ds) AS x FROM d),
    f AS (SELECT o_orderpriority, sum(w * x) / sum(x * x) AS b, sum(x * x) AS xx, sum(w * w) AS ww, sum(w * x) AS wx, count(*) AS n
          FROM l WHERE w IS NOT NULL AND x IS NOT NULL GROUP BY 1),
    e AS (SELECT *, sqrt((ww - b * wx) / (n - 1) / xx) AS se FROM f)
    SELECT o_orderpriority, 'ar_1' AS term, round(b, 6) AS estimate, round(se, 6) AS stderr,
      round(b - 1.959963984540054 * se, 6) AS low, round(b + 1.959963984540054 * se, 6) AS high FROM e""")
def first_order_coefficients(t):
    model = ar.fit(weekly_by_priority(t), ar.Order(1, 1, 0), BY)
    return co.round_columns(model.interval_table(), 6)


@query("Y7", "Y10", sql=f"""
    WITH n AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY ds DESC) - 1 AS back FROM {WEEKLY_BY_SQL}),
    e AS (SELECT o_orderpriority, max(ds) AS last, max(y) FILTER (back = 0) AS y0, max(y) FILTER (back = 51) AS y51,
            max(y) FILTER (back = 52) AS y52 FROM n GROUP BY 1)
    SELECT o_orderpriority, (last + CAST(7 * (52 - back) AS INTEGER))::VARCHAR AS ds, round(y + y0 - y52, 2) AS yhat
    FROM n JOIN e USING (o_orderpriority) WHERE back BETWEEN 0 AND 51
    UNION ALL SELECT o_orderpriority, (last + 371)::VARCHAR, round(y51 + 2 * (y0 - y52), 2) FROM e""")
def seasonal_walk_outlook(t):
    return _dated(co.round_columns(ar.seasonal_walk_forecast(weekly_by_priority(t), 52, 53, 7, BY), 2))


@query("Y8", "J5", "Y19")
def arima_with_shipments(t):
    both = paired_weeks(t).dropna()
    model = ar.fit(both, ar.Order(3, 1, 3, 1, 1, 1, 52, trend=True), exog=["x"])
    return co.round_columns(model.interval_table(), 6)


@query("Y16")
def arima_grid(t):
    orders = [ar.Order(*o) for o in product((0, 1, 2), (0, 1), (0, 1, 2), (0, 1, 2), (0, 1), (0, 1, 2), (12, 52))]
    grid = ar.grid_aic(weekly_by_priority(t), orders, BY)
    return co.round_columns(ar.best_orders(grid, BY), 4)


@query("Y17", "Y3", "C1")
def arima_residual_checks(t):
    model = ar.fit(weekly_by_priority(t), ar.Order(2, 1, 1), BY)
    return co.round_columns(dg.residual_checks(model.history, by=BY), 6)


@query("Y17", "C3")
def arima_residual_histogram(t):
    model = ar.fit(weekly_by_priority(t), ar.Order(2, 1, 1), BY)
    return co.round_columns(dg.residual_histogram(model.history, 20, by=BY), 4)


@query("Y11", "Y14", "Y15", "D14")
def trend_forecast(t):
    series = weekly_by_priority(t)
    shape = tr.Shape(weekly=0, changepoint_scale=0.1)
    fitted = tr.fit(series, shape, BY)
    future = ca.extend(series, "ds", 52, 7, BY)
    return _dated(co.round_columns(tr.predict(future, fitted, shape, BY), 2))


@query("Y11", "Y14")
def daily_trend_residuals(t):
    daily = sp.regular(t.orders, "o_orderdate", "o_totalprice", "day", BY)
    shape = tr.Shape()
    predicted = tr.predict(daily, tr.fit(daily, shape, BY), shape, BY)
    return _dated(co.round_columns(tr.residuals(daily, predicted, BY), 2))


@query("Y12", "Y15")
def trend_with_given_changepoints(t):
    series = weekly_orders(t)
    shape = tr.Shape(changepoint_dates=("1996-03-03", "1997-09-07", "1999-11-14"), weekly=0)
    return _dated(co.round_columns(tr.predict(ca.extend(series, "ds", 53, 7), tr.fit(series, shape), shape), 2))


@query("Y11", "Y12")
def trend_changes(t):
    """The changes of slope that remain of 25 candidates, per priority, next to the fit's size."""
    series = weekly_by_priority(t)
    shape = tr.Shape(weekly=0, sparse=True)
    found = tr.changes(tr.fit(series, shape, BY), shape, BY)
    return _dated(co.round_columns(found, 4))


@query("Y13", "P10")
def saturating_trend(t):
    counts = t.events.groupBy("event_type", F.to_date("ts").alias("ds")).agg(F.count(F.lit(1)).cast("double").alias("y"))
    top = counts.agg(F.max("y")).first()[0]
    shape = tr.Shape(changepoints=5, yearly=0, capacity=float(top) * 1.2)
    fitted = tr.fit(counts, shape, ["event_type"])
    future = ca.extend(counts, "ds", 60, 1, ["event_type"])
    return _dated(co.round_columns(tr.predict(future, fitted, shape, ["event_type"]), 4))


@query("R5", "Y11")
def trend_cross_validation(t):
    grid = [(c, s) for c in (0.001, 0.01, 0.1, 0.5) for s in (0.01, 0.1, 1.0, 10.0)]
    shape = tr.Shape(weekly=0)
    scores = tr.rolling_origin(weekly_orders(t), shape, grid, horizon_days=30)
    return co.round_columns(scores, 4)
