"""Calendar bins and series extension."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions.dates import iso_text
from larkspur.operators import calendar as ca
from larkspur.plans.registry import query

SUNDAY = "CAST(o_orderdate AS DATE) + CAST(7 - isodow(o_orderdate) AS INTEGER)"
# Weekly order amounts on a dense calendar: a week without orders counts as 0.
WEEKLY_SQL = f"""(WITH g AS (SELECT {SUNDAY} AS ds, round(sum(o_totalprice), 2) AS y FROM orders GROUP BY 1),
    w AS (SELECT CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 7 DAY)) AS DATE) AS ds FROM g)
    SELECT ds, coalesce(y, 0) AS y FROM w LEFT JOIN g USING (ds))"""

# The same per priority.
WEEKLY_BY_SQL = f"""(WITH g AS (SELECT o_orderpriority, {SUNDAY} AS ds, round(sum(o_totalprice), 2) AS y FROM orders GROUP BY 1, 2),
    w AS (SELECT o_orderpriority, CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 7 DAY)) AS DATE) AS ds FROM g GROUP BY 1)
    SELECT o_orderpriority, ds, coalesce(y, 0) AS y FROM w LEFT JOIN g USING (o_orderpriority, ds))"""


@query("D11", sql=f"""
    WITH b AS (SELECT {SUNDAY} AS week, o_totalprice FROM orders),
    g AS (SELECT week, round(sum(o_totalprice), 2) AS s, round(avg(o_totalprice), 8) AS m FROM b GROUP BY 1),
    w AS (SELECT CAST(unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS DATE) AS week FROM g)
    SELECT week::VARCHAR AS week, coalesce(s, 0) AS total, m AS mean FROM w LEFT JOIN g USING (week)""")
def weekly_orders(t):
    weekly = ca.resample(t.orders, "o_orderdate", "week_sunday", ["o_totalprice"], ["o_totalprice"], label="week")
    return weekly.select(
        iso_text(F.col("week")).alias("week"), F.round("sum_o_totalprice", 2).alias("total"),
        F.round("mean_o_totalprice", 8).alias("mean"),
    )


@query("D12", sql="""
    WITH b AS (SELECT o_orderpriority, last_day(o_orderdate) AS month, o_totalprice FROM orders),
    g AS (SELECT o_orderpriority, month, round(sum(o_totalprice), 2) AS s FROM b GROUP BY 1, 2),
    w AS (SELECT o_orderpriority, last_day(CAST(unnest(generate_series(date_trunc('month', min(month)), date_trunc('month', max(month)),
            INTERVAL 1 MONTH)) AS DATE)) AS month FROM g GROUP BY 1)
    SELECT o_orderpriority, month::VARCHAR AS month, coalesce(s, 0) AS total FROM w LEFT JOIN g USING (o_orderpriority, month)""")
def monthly_orders_by_priority(t):
    monthly = ca.resample(t.orders, "o_orderdate", "month", ["o_totalprice"], by=["o_orderpriority"], label="month")
    return monthly.select(
        "o_orderpriority", iso_text(F.col("month")).alias("month"), F.round("sum_o_totalprice", 2).alias("total")
    )


@query("D13", sql="""
    WITH b AS (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week, o_totalprice FROM orders),
    g AS (SELECT week, round(avg(o_totalprice), 8) AS m FROM b GROUP BY 1),
    w AS (SELECT CAST(unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS DATE) AS week FROM g)
    SELECT week::VARCHAR AS week, m AS mean FROM w LEFT JOIN g USING (week)""")
def monday_weekly_means(t):
    weekly = ca.resample(t.orders, "o_orderdate", "week_monday", means=["o_totalprice"], label="week")
    return weekly.select(iso_text(F.col("week")).alias("week"), F.round("mean_o_totalprice", 8).alias("mean"))


@query("D11", "D13", sql=f"""
    WITH b AS (SELECT {SUNDAY} AS week, o_totalprice FROM orders WHERE week(o_orderdate) % 5 <> 0),
    g AS (SELECT week, round(sum(o_totalprice), 2) AS s, round(avg(o_totalprice), 8) AS m FROM b GROUP BY 1),
    w AS (SELECT CAST(unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS DATE) AS week FROM g)
    SELECT week::VARCHAR AS week, coalesce(s, 0) AS total, m AS mean FROM w LEFT JOIN g USING (week)""")
def weekly_orders_with_idle_weeks(t):
    # Every fifth week is idle, so that empty bins have to be made.
    busy = t.orders.where(F.weekofyear("o_orderdate") % 5 != 0)
    weekly = ca.resample(busy, "o_orderdate", "week_sunday", ["o_totalprice"], ["o_totalprice"], label="week")
    return weekly.select(
        iso_text(F.col("week")).alias("week"), F.round("sum_o_totalprice", 2).alias("total"),
        F.round("mean_o_totalprice", 8).alias("mean"),
    )


@query("D14", sql="""
    WITH d AS (SELECT event_type, CAST(ts AS DATE) AS ds, CAST(count(*) AS DOUBLE) AS y FROM events GROUP BY 1, 2),
    f AS (SELECT event_type, max(ds) AS last FROM d GROUP BY 1)
    SELECT event_type, ds::VARCHAR AS ds, y FROM d
    UNION ALL SELECT event_type, (last + CAST(k AS INTEGER))::VARCHAR, NULL FROM f, range(1, 31) AS r(k)""")
def daily_events_extended(t):
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("ds")).agg(F.count(F.lit(1)).cast("double").alias("y"))
    return ca.extend(daily, "ds", 30, by=["event_type"]).select("event_type", iso_text(F.col("ds")).alias("ds"), "y")
