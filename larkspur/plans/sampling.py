"""Splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.operators import aggregates as ag
from larkspur.operators import sampling as sa
from larkspur.plans.registry import query

SPREAD = "(o_orderkey * 7919 + 13) % 10007"


@query("R1", sql=f"""
    SELECT ({SPREAD} < 8005.6)::INT AS is_train, count(*) AS orders, round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY 1""")
def arithmetic_split(t):
    share = F.expr(SPREAD)
    parted = t.orders.select((share < 8005.6).cast("int").alias("is_train"), "o_totalprice")
    return ag.group_named(parted, ["is_train"], orders=F.count(F.lit(1)), amount=F.round(F.sum("o_totalprice"), 2))


@query("R1")
def hashed_split(t):
    train, test = sa.split_by_key(t.orders, ["o_orderkey"], 0.8, seed=123)
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return ag.group_count(both, ["side"], "orders")


@query("R2", sql=f"""
    SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {SPREAD}, o_orderkey)
      <= ceil(round(count(*) OVER (PARTITION BY o_orderstatus) * 0.7::DOUBLE, 9)) AS is_train FROM orders""")
def stratified_split(t):
    slim = t.orders.select("o_orderkey", "o_orderstatus", F.expr(SPREAD).alias("spread"))
    return sa.split_stratified(slim, "o_orderstatus", 0.7, ["spread", "o_orderkey"]).select("o_orderkey", "is_train")


@query("R3", "W5", sql=f"""
    SELECT o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {SPREAD}, o_orderkey) AS rn
      FROM orders) WHERE rn <= 2292""")
def fixed_rows_per_class(t):
    slim = t.orders.select("o_orderkey", "o_orderpriority", F.expr(SPREAD).alias("spread"))
    return sa.sample_per_class(
        slim, "o_orderpriority", 2292, ["o_orderkey"], order=["spread", "o_orderkey"]
    ).drop("spread")
