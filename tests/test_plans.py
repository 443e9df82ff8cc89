"""Plans: filters and columns reach the scan, sums come before joins, nothing is a cross join."""

import re

import pytest

from larkspur.operators import calendar, quantiles
from larkspur.plans import load_all

FOLDER = "/root/testdata/sf0.001"
CATALOG = load_all()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_threshold_is_pushed_down(spark):
    text = physical(CATALOG["keep_large_orders"](spark, FOLDER))
    assert "GreaterThan(o_totalprice,400000" in text
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>", text)


def test_null_keys_are_pushed_down(spark):
    assert "IsNotNull(o_custkey)" in physical(CATALOG["top_nations_by_amount"](spark, FOLDER))


def test_quantile_brackets_reach_the_scan(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SMALL_GROUP_ROWS", 0)
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    text = physical(quantiles.exact_quantiles(lines, ["l_extendedprice"], [0.5]))
    assert "GreaterThanOrEqual(l_extendedprice," in text  # long lists of filters are shortened in the text


def test_calendar_reads_its_source_once(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    weekly = calendar.extend(calendar.resample(orders, "o_orderdate", "week_sunday", ["o_totalprice"], label="ds"), "ds", 5, 7)
    assert physical(weekly).count("FileScan") == 1 and "Join" not in physical(weekly)


@pytest.mark.parametrize("name", [
    "top_nations_by_amount", "quarter_region_subtotals", "prices_inside_fence", "gaps_to_mean", "prices_from_quantity",
    "parts_scaled", "amount_histogram", "event_value_density", "weekly_orders", "event_value_boxes",
    "fixed_rows_per_class", "income_from_lookup", "trend_forecast", "arima_grid",
])
def test_no_cross_joins(spark, name):
    text = physical(CATALOG[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_sums_before_joins(spark):
    text = physical(CATALOG["quarter_region_subtotals"](spark, FOLDER))
    scan = text.index("l_extendedprice")
    assert "partial_sum(l_extendedprice" in text[scan - 200:]
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and "l_orderkey" in line)
    assert any("HashAggregate(keys=[l_orderkey" in line for line in lines[max(0, at - 5):at])
