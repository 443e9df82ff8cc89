"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Every
result is written to Spark's noop sink, so all rows and columns are computed.
Each query runs three times (``--runs``) and its median counts.
``--all`` times the whole catalog, ``--only a,b`` a selection.
"""

from __future__ import annotations

import argparse
import json
import os
import re
import sys
import time
from statistics import median

from larkspur.plans import load_all
from larkspur.session import build_session

HEADLINE = """
top_nations_by_amount sales_by_region_and_type quarter_region_subtotals quantity_discount_pairs flag_status_medians
price_quantiles prices_inside_fence describe_measures distinct_count_per_column null_count_per_column numbered_orders
orders_without_ends keep_complete_lines gaps_to_mean income_from_lookup prices_from_quantity chained_customer_aggregates
yearly_sales_of_top_parts money_text_parsed mixed_date_layouts documents_through_csv weekly_orders amount_histogram
event_value_boxes event_value_density measure_correlations warm_season_test label_fit_measures stratified_split
fixed_rows_per_class standardised_lines price_regression_table price_gradient_descent elastic_net_errors boosted_scores
embedding_clusters running_orders_per_priority weekly_autocorrelation unit_root_by_priority arima_forecast arima_grid
trend_forecast trend_cross_validation
""".split()


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--all", action="store_true")
    parser.add_argument("--only", default="")
    parser.add_argument("--runs", type=int, default=3, help="runs of each query; the median counts")
    args = parser.parse_args()
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    catalog = load_all()
    names = [n for n in args.only.split(",") if n] or (list(catalog) if args.all else HEADLINE)
    spark = build_session(f"local[{cpus}]", "larkspur-bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.log.level": "ERROR",
        "spark.ui.showConsoleProgress": "false",
        # The test files are a few MB each: cut them so that all cores read.
        "spark.sql.files.openCostInBytes": "262144",
    })
    catalog["priority_frequency"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in names:
        taken = []
        for _ in range(args.runs):
            start = time.perf_counter()
            catalog[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(median(taken), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)/?$", folder)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(scale.group(1)) if scale else folder,
    }))


if __name__ == "__main__":
    main()
