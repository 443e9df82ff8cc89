"""Selecting, filtering, sorting, joining and grouping."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions import text as tx
from larkspur.operators import aggregates as ag
from larkspur.operators import columns as co
from larkspur.operators import joins as jo
from larkspur.operators import rows as ro
from larkspur.operators.ranking import number_rows, top_n
from larkspur.plans.registry import query

# ---------------------------------------------------------------- grouping


def sales(t):
    """Line items with part, order date and region of the customer."""
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    placed = lines.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return placed.join(nation_regions(t), F.col("c_nationkey") == F.col("n_nationkey"))


def nation_regions(t):
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))


@query("A1", "O3", "C5", "C10", sql="""
    SELECT n_name, round(sum(o_totalprice), 2) AS amount
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name ORDER BY amount DESC, n_name LIMIT 5""")
def top_nations_by_amount(t):
    # Sums travel up the keys: one row per customer meets the customers, one row per nation key the nations.
    per_customer = ag.group_sum(t.orders.select("o_custkey", "o_totalprice"), ["o_custkey"])
    placed = per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    totals = ag.group_sum(placed, ["c_nationkey"], ["o_totalprice"])
    named = totals.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    amounts = named.select("n_name", F.round("o_totalprice", 2).alias("amount"))
    return top_n(amounts, "amount", 5, ["n_name"])


@query("A1", "A11", sql="""
    SELECT l_shipmode_key, round(sum(l_quantity), 2) AS l_quantity, round(sum(l_extendedprice), 2) AS l_extendedprice,
           round(sum(l_tax), 2) AS l_tax, round(sum(l_discount), 2) AS l_discount
    FROM (SELECT CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_returnflag END AS l_shipmode_key, * FROM lineitem)
    WHERE l_shipmode_key IS NOT NULL GROUP BY 1""")
def group_sum_all_measures(t):
    keyed = t.lineitem.select(
        F.when(F.col("l_partkey") % 11 != 0, F.col("l_returnflag")).alias("l_shipmode_key"),
        "l_quantity", "l_extendedprice", "l_tax", "l_discount",
    )
    return co.round_columns(ag.group_sum(keyed, ["l_shipmode_key"]), 2)


BAND_EDGES = [0, 80_000, 160_000, 240_000, 320_000, 640_000, 900_000]
BAND_LABELS = ["tiny", "small", "middling", "large", "huge", "unheard of"]


@query("A2", "T10", sql="""
    WITH bands(rank, band) AS (VALUES (0, 'tiny'), (1, 'small'), (2, 'middling'), (3, 'large'), (4, 'huge'), (5, 'unheard of')),
    banded AS (SELECT CASE WHEN o_totalprice <= 0 THEN NULL WHEN o_totalprice <= 80000 THEN 'tiny'
                 WHEN o_totalprice <= 160000 THEN 'small' WHEN o_totalprice <= 240000 THEN 'middling'
                 WHEN o_totalprice <= 320000 THEN 'large' WHEN o_totalprice <= 640000 THEN 'huge'
                 WHEN o_totalprice <= 900000 THEN 'unheard of' END AS band,
                 o_totalprice FROM orders)
    SELECT rank, b.band, round(coalesce(sum(o_totalprice), 0), 2) AS amount
    FROM bands b LEFT JOIN banded USING (band) GROUP BY rank, b.band""")
def amount_per_band(t):
    banded = t.orders.select(
        tx.band(F.col("o_totalprice"), BAND_EDGES, BAND_LABELS).alias("band"), F.col("o_totalprice").alias("amount")
    )
    return co.round_columns(ag.group_sum_all_levels(banded, "band", BAND_LABELS, ["amount"]), 2)


@query("A3", sql="""
    SELECT o_orderpriority, count(*) AS orders FROM orders GROUP BY 1 ORDER BY 2 DESC, 1""")
def priority_frequency(t):
    return ag.frequency(t.orders, "o_orderpriority", "orders")


@query("A4", "C6", sql="""
    SELECT l_quantity, l_discount, count(*) AS count FROM lineitem GROUP BY 1, 2""")
def quantity_discount_pairs(t):
    return ag.group_count(t.lineitem, ["l_quantity", "l_discount"])


@query("A5", "O2", sql="""
    SELECT r_name, p_type, round(sum(l_extendedprice), 2) AS sales, round(sum(l_quantity), 2) AS quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
    GROUP BY 1, 2 ORDER BY r_name, sales DESC""")
def sales_by_region_and_type(t):
    # Summed by region and part first, so that a part sold everywhere meets its type once per region.
    sold = sales(t).select("r_name", "l_partkey", F.col("l_extendedprice").alias("sales"), F.col("l_quantity").alias("quantity"))
    by_part = sold.groupBy("r_name", "l_partkey").agg(F.sum("sales").alias("sales"), F.sum("quantity").alias("quantity"))
    typed = by_part.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("r_name", "p_type", "sales", "quantity")
    grouped = co.round_columns(ag.group_sum(typed, ["r_name", "p_type"]), 2)
    return ro.sort_by(grouped, ("r_name", True), ("sales", False))


@query("A6", "D3", "P12", sql="""
    SELECT month(o_orderdate) AS month, monthname(o_orderdate) AS month_name, count(*) AS orders,
           round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 4) AS mean
    FROM orders GROUP BY 1, 2 ORDER BY 1""")
def monthly_named_aggregates(t):
    from larkspur.functions.dates import month_name

    keyed = t.orders.select(
        F.month("o_orderdate").alias("month"), month_name(F.col("o_orderdate")).alias("month_name"), "o_totalprice"
    )
    return ag.group_named(
        keyed, ["month", "month_name"],
        orders=F.count(F.lit(1)), total=F.round(F.sum("o_totalprice"), 2), mean=F.round(F.avg("o_totalprice"), 4),
    ).orderBy("month")


@query("A7", "C7", sql="""
    SELECT p_brand, round(avg(p_retailprice), 6) AS p_retailprice, round(avg(p_size), 6) AS p_size FROM part GROUP BY 1""")
def brand_means(t):
    return co.round_columns(ag.group_mean(t.part, ["p_brand"], ["p_retailprice", "p_size"]), 6)


@query("A8", sql="""
    SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 6) AS l_extendedprice, round(median(l_quantity), 6) AS l_quantity
    FROM (SELECT l_returnflag, l_linestatus, l_extendedprice,
                 CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END AS l_quantity FROM lineitem)
    WHERE l_quantity IS NOT NULL GROUP BY 1, 2""")
def flag_status_medians(t):
    gaps = t.lineitem.withColumn("l_quantity", F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")))
    medians = ag.group_median(gaps, ["l_returnflag", "l_linestatus"], ["l_extendedprice", "l_quantity"])
    return co.round_columns(medians, 6)


EMBEDDING_WIDTH = 64


@query("A9", sql=f"""
    SELECT label, {", ".join(f"round(avg(embedding[{i + 1}]), 4) AS e{i}" for i in range(EMBEDDING_WIDTH))}, count(*) AS count
    FROM embeddings GROUP BY 1""")
def label_profile(t):
    names = [f"e{i}" for i in range(EMBEDDING_WIDTH)]
    wide = t.embeddings.select("label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    return ag.segment_profile(wide, "label", names)


@query("A10", sql="""
    SELECT min(o_totalprice) AS min, max(o_totalprice) AS max, round(avg(o_totalprice), 4) AS mean,
           round(stddev_samp(o_totalprice), 4) AS std FROM orders""")
def amount_extremes(t):
    from larkspur.operators.profile import extremes

    return co.round_columns(extremes(t.orders, "o_totalprice"), 4, ["mean", "std"])


@query("A11", "W2", sql="""
    SELECT strftime(l_shipdate, '%Y-%m-%d') AS ship_day, round(sum(l_quantity), 2) AS l_quantity,
           round(sum(l_extendedprice), 2) AS l_extendedprice FROM lineitem GROUP BY 1""")
def measures_per_ship_day(t):
    daily = t.lineitem.select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_day"), "l_returnflag", "l_quantity", "l_extendedprice"
    )
    return co.round_columns(ag.pivot_by_date(daily, "ship_day"), 2)


@query("A12", "D6", sql="""
    WITH fine AS (SELECT year(o_orderdate) || '/0' || quarter(o_orderdate) AS quarter, r_name, l_extendedprice
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT quarter, r_name, CAST(grouping(r_name) AS INTEGER) AS level, round(sum(l_extendedprice), 2) AS sales
    FROM fine GROUP BY GROUPING SETS ((quarter, r_name), (quarter))""")
def quarter_region_subtotals(t):
    from larkspur.functions.dates import quarter_label

    # Pre-aggregated before each join, so a hot order or customer arrives there as a few rows.
    per_order = ag.group_sum(t.lineitem.select("l_orderkey", "l_extendedprice"), ["l_orderkey"], ["l_extendedprice"])
    dated = per_order.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey", quarter_label(F.col("o_orderdate")).alias("quarter"), "l_extendedprice"
    )
    per_customer = ag.group_sum(dated, ["o_custkey", "quarter"], ["l_extendedprice"])
    placed = per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    per_nation = ag.group_sum(placed, ["c_nationkey", "quarter"], ["l_extendedprice"])
    keyed = per_nation.join(nation_regions(t), F.col("c_nationkey") == F.col("n_nationkey"))
    return co.round_columns(ag.subtotals(keyed, "quarter", "r_name", sales=F.col("l_extendedprice")), 2)


@query("A13", sql="""
    SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O,
           count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1""")
def priority_status_table(t):
    return ag.cross_table(t.orders, "o_orderpriority", "o_orderstatus", ag.levels_of(t.orders, "o_orderstatus"))


@query("A14", sql="""
    SELECT round(quantile_cont(l_extendedprice, 0.05), 6) AS p05, round(quantile_cont(l_extendedprice, 0.25), 6) AS q1,
           round(quantile_cont(l_extendedprice, 0.5), 6) AS median, round(quantile_cont(l_extendedprice, 0.75), 6) AS q3,
           round(quantile_cont(l_extendedprice, 0.95), 6) AS p95 FROM lineitem""")
def price_quantiles(t):
    names = {"p05": 0.05, "q1": 0.25, "median": 0.5, "q3": 0.75, "p95": 0.95}
    return co.round_columns(ag.quantiles(t.lineitem, "l_extendedprice", names), 6)


# ---------------------------------------------------------------- columns


@query("P1", "P8", "X3", sql="""
    SELECT p_type, p_partkey, p_brand FROM part""")
def select_by_name(t):
    return t.part.transform(co.select_names, ["p_partkey", "p_brand", "p_type"]).transform(co.move_column, "p_type")


@query("P2", "P3", sql="""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders""")
def select_and_drop_by_position(t):
    return co.select_positions(co.drop_positions(t.orders, [2, 4, 5]), [0, 1, 2])


@query("P4", "P5", sql="SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def drop_by_name_and_prefix(t):
    kept = co.drop_names(t.lineitem, ["l_extendedprice", "l_tax", "l_shipdate", "l_discount"])
    slim = co.drop_prefix_columns(kept, "l_part", "l_supp", "l_return")
    return co.select_prefix(slim, "l_order", "l_linenumber", "l_quantity")


@query("P6", "I2", sql="""
    SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""")
def select_by_type(t):
    return co.select_types(t.lineitem, T.DoubleType)


@query("P7", sql="SELECT s_suppkey AS suppkey, s_name AS supplier, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier")
def rename_columns(t):
    return co.rename(co.rename_pattern(t.supplier, "^s_"), {"name": "supplier"})


@query("P9", "P12", "X2", sql="""
    SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS unit_price,
           l_quantity * CAST(0.45359237 AS DOUBLE) AS weight_kg, round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS charge,
           round(l_extendedprice - l_extendedprice * (1 - l_discount), 6) AS reduction
    FROM lineitem""")
def derived_measures(t):
    price, keep = F.col("l_extendedprice"), 1 - F.col("l_discount")
    measured = t.lineitem.select(
        "l_orderkey", "l_linenumber",
        (price / F.col("l_quantity")).alias("unit_price"),
        (F.col("l_quantity") * 0.45359237).alias("weight_kg"),
        (price * keep * (1 + F.col("l_tax"))).alias("charge"),
        (price - price * keep).alias("reduction"),
    )
    return co.round_columns(measured, 6, ["charge", "reduction"])


@query("P10", "P11", sql="""
    SELECT c_custkey, CAST(c_acctbal AS BIGINT) AS c_acctbal, TRY_CAST(c_mktsegment AS INTEGER) IS NULL AS bad_cast,
           CAST(230 AS DOUBLE) AS capacity FROM (SELECT c_custkey, trunc(c_acctbal) AS c_acctbal, c_mktsegment FROM customer)""")
def constants_and_casts(t):
    cast = co.cast_columns(t.customer, {"c_acctbal": "bigint", "c_mktsegment": "int"})
    return co.add_constant(cast, "capacity", 230.0).select(
        "c_custkey", "c_acctbal", F.col("c_mktsegment").isNull().alias("bad_cast"), "capacity"
    )


@query("P13", "P14", sql="""
    SELECT l_orderkey, l_linenumber, round(l_quantity + l_discount + l_tax, 4) AS load
    FROM lineitem""")
def predictors_row_sum(t):
    predictors, _ = co.split_target(t.lineitem, "l_extendedprice")
    return predictors.select(
        "l_orderkey", "l_linenumber", F.round(co.row_sum(["l_quantity", "l_discount", "l_tax"]), 4).alias("load")
    )


@query("P15", sql="""
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_number FROM orders""")
def numbered_orders(t):
    return number_rows(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


# ---------------------------------------------------------------- rows


@query("F1", sql="SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def keep_segments(t):
    return ro.keep_values(t.customer, "c_mktsegment", ["BUILDING", "MACHINERY"])


GAPPY_SQL = """(SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END AS l_quantity,
    CASE WHEN l_partkey % 5 <> 0 THEN l_extendedprice END AS l_extendedprice,
    CASE WHEN l_suppkey % 3 <> 0 THEN l_returnflag END AS l_returnflag, l_discount FROM lineitem)"""


def gappy_lines(t):
    """Line items with gaps that depend on the keys; the tables themselves have none."""
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(F.col("l_suppkey") % 3 != 0, F.col("l_returnflag")).alias("l_returnflag"),
        "l_discount",
    )


@query("F2", sql=f"SELECT l_orderkey, l_linenumber FROM {GAPPY_SQL} WHERE l_quantity IS NULL AND l_extendedprice IS NOT NULL")
def keep_null_quantity(t):
    return ro.keep_not_null(ro.keep_null(gappy_lines(t), "l_quantity"), "l_extendedprice").select("l_orderkey", "l_linenumber")


@query("F3", sql="SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000")
def keep_large_orders(t):
    return ro.keep_above(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 400_000)


@query("F4", sql="""
    SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_quantity BETWEEN 10 AND 20 AND l_discount BETWEEN 0.02 AND 0.05""")
def keep_quantity_box(t):
    boxed = ro.keep_box(t.lineitem, {"l_quantity": (10.0, 20.0), "l_discount": (0.02, 0.05)})
    return boxed.select("l_orderkey", "l_linenumber")


@query("F5", "U1", sql="""
    SELECT CASE WHEN o_orderstatus = 'F' THEN 'finished' ELSE 'open' END AS part, count(*) AS orders,
           round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY 1""")
def split_by_status(t):
    done, rest = ro.split_equal(t.orders, "o_orderstatus", "F")
    both = ro.append(done.withColumn("part", F.lit("finished")), rest.withColumn("part", F.lit("open")))
    return ag.group_named(both, ["part"], orders=F.count(F.lit(1)), amount=F.round(F.sum("o_totalprice"), 2))


@query("F6", sql="SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount <> 0")
def keep_discounted(t):
    return ro.keep_non_zero(t.lineitem.select("l_orderkey", "l_linenumber", "l_discount"), "l_discount")


@query("F7", sql="SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^(small|red) .*g')")
def keep_name_pattern(t):
    return ro.keep_match(t.part.select("p_partkey", "p_name"), "p_name", "^(small|red) .*g")


@query("F8", sql=f"""
    SELECT * FROM {GAPPY_SQL} WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL AND l_returnflag IS NOT NULL""")
def keep_complete_lines(t):
    return ro.keep_complete(gappy_lines(t))


@query("F9", sql=f"""
    SELECT l_orderkey, l_linenumber FROM {GAPPY_SQL}
    WHERE l_quantity IS NULL OR l_extendedprice IS NULL OR l_returnflag IS NULL""")
def keep_incomplete_lines(t):
    return ro.keep_incomplete(gappy_lines(t)).select("l_orderkey", "l_linenumber")


@query("F10", sql="""
    SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn,
      count(*) OVER () AS n FROM orders) WHERE rn > 1 AND rn <= n - 52""")
def orders_without_ends(t):
    order = ["o_orderdate", "o_orderkey"]
    slim = t.orders.select(*order)
    return ro.drop_last(ro.drop_first(slim, order, 1), order, 52).select("o_orderkey")


@query("F10", "K5", sql="""
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 13 OFFSET 14""")
def orders_by_place(t):
    slim = t.orders.select("o_orderkey", "o_totalprice")
    return ro.slice_rows(slim, [F.col("o_totalprice").desc(), "o_orderkey"], 14, 27)


@query("F11", sql="""
    WITH q AS (SELECT round(quantile_cont(l_extendedprice, 0.25), 6) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem, q
    WHERE l_extendedprice >= q1 - 1.5 * (q3 - q1) AND l_extendedprice <= q3 + 1.5 * (q3 - q1)""")
def prices_inside_fence(t):
    return ro.outlier_fence(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_extendedprice")


@query("O1", "K5", sql="SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS day FROM orders ORDER BY o_orderkey DESC LIMIT 20")
def last_orders(t):
    latest = ro.tail(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderkey"], 20)
    return ro.sort_by(latest, ("o_orderkey", False)).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("O4", sql="""
    SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 10""")
def lowest_balances(t):
    return top_n(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", 10, ["c_custkey"], largest=False)


@query("O5", sql="""
    SELECT n_name, round(sum(c_acctbal - 5000), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey
    GROUP BY 1 ORDER BY abs(balance) DESC""")
def nations_by_balance_size(t):
    totals = t.customer.groupBy("c_nationkey").agg(F.round(F.sum(F.col("c_acctbal") - 5000), 2).alias("balance"))
    named = totals.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "balance")
    return ro.sort_by_magnitude(named, "balance", ["n_name"])


# ---------------------------------------------------------------- joins


@query("J1", sql="""
    SELECT c_custkey, c_name, n_name, CAST(n_regionkey AS DOUBLE) AS n_regionkey FROM customer
    LEFT JOIN (SELECT * FROM nation WHERE n_nationkey > 3) ON c_nationkey = n_nationkey""")
def customers_with_nation(t):
    known = t.nation.where("n_nationkey > 3")
    joined = jo.lookup_join(t.customer, known, "c_nationkey", "n_nationkey", ["n_name", "n_regionkey"])
    return joined.select("c_custkey", "c_name", "n_name", F.col("n_regionkey").cast("double").alias("n_regionkey"))


@query("J2", sql="""
    SELECT s_suppkey, s_nationkey, customers FROM supplier
    LEFT JOIN (SELECT c_nationkey AS s_nationkey, count(*) AS customers FROM customer GROUP BY 1) USING (s_nationkey)""")
def suppliers_with_market_size(t):
    size = ag.group_count(t.customer.select(F.col("c_nationkey").alias("s_nationkey")), ["s_nationkey"], "customers")
    return jo.left_join(t.supplier.select("s_suppkey", "s_nationkey"), size, "s_nationkey")


@query("J3", sql="""
    SELECT c_custkey, orders, mean, largest, c_acctbal, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN (SELECT o_custkey AS c_custkey, count(*) AS orders, round(sum(o_totalprice), 2) / count(*) AS mean,
          max(o_totalprice) AS largest FROM orders GROUP BY 1) USING (c_custkey)""")
def chained_customer_aggregates(t):
    # One aggregate for all three measures; the chain joins tables that differ.
    measures = ag.group_named(
        t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_totalprice"), ["c_custkey"],
        orders=F.count(F.lit(1)), mean=F.round(F.sum("o_totalprice"), 2) / F.count(F.lit(1)), largest=F.max("o_totalprice"),
    )
    nations = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    return jo.inner_chain([measures, t.customer.select("c_custkey", "c_acctbal"), nations], "c_custkey")


@query("J6", sql="""
    SELECT c_custkey, CASE WHEN o.best IS NOT NULL THEN o.best ELSE c_acctbal END AS c_acctbal
    FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS best FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) o
      ON c_custkey = o_custkey""")
def balances_updated(t):
    pending = t.orders.where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_totalprice").alias("c_acctbal")
    )
    return jo.update_rows(t.customer.select("c_custkey", "c_acctbal"), pending, "c_custkey", ["c_acctbal"])


@query("J7", sql="""
    SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def customers_without_orders(t):
    placed = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    return jo.anti_join(t.customer.select("c_custkey"), placed)


@query("J8", "O3", sql="""
    SELECT l_partkey, year(l_shipdate) AS year, round(sum(l_extendedprice), 2) AS sales FROM lineitem
    WHERE l_partkey IN (SELECT l_partkey FROM lineitem GROUP BY 1 ORDER BY round(sum(l_extendedprice), 2) DESC, 1 LIMIT 12)
    GROUP BY 1, 2""")
def yearly_sales_of_top_parts(t):
    slim = t.lineitem.select("l_partkey", "l_shipdate", "l_extendedprice")
    best = jo.semi_join_top(slim, "l_partkey", F.round(F.sum("l_extendedprice"), 2), 12)
    return ag.group_named(
        best.withColumn("year", F.year("l_shipdate")), ["l_partkey", "year"], sales=F.round(F.sum("l_extendedprice"), 2)
    )


@query("K3", sql="""
    SELECT "p_type" AS kind, count(*) AS parts, round(avg(p_retailprice), 4) AS mean_price FROM part GROUP BY 1""")
def sql_view_question(t):
    t.part.withColumnRenamed("p_type", "part type").createOrReplaceTempView("larkspur_part")
    return t.spark.sql(
        "SELECT `part type` AS kind, count(*) AS parts, round(avg(p_retailprice), 4) AS mean_price "
        "FROM larkspur_part GROUP BY `part type`"
    )
