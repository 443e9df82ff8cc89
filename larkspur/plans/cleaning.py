"""Text repair, recoding, date parsing and filling of gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions import dates as dt
from larkspur.functions import text as tx
from larkspur.operators import columns as co
from larkspur.operators import repair as rp
from larkspur.plans.registry import query
from larkspur.plans.relational import GAPPY_SQL, gappy_lines

# ---------------------------------------------------------------- text


@query("T1", sql="""
    SELECT p_partkey, replace(p_brand, 'Brand', 'B') AS brand, regexp_replace(p_name, '[aeiou]+', '_', 'g') AS name FROM part""")
def replaced_names(t):
    return t.part.select(
        "p_partkey",
        tx.replace_literal(F.col("p_brand"), "Brand", "B").alias("brand"),
        tx.replace_pattern(F.col("p_name"), "[aeiou]+", "_").alias("name"),
    )


@query("T2", "P9", sql="""
    SELECT o_orderkey, o_totalprice AS amount, o_totalprice / (o_custkey % 6 + 1) AS per_person FROM orders""")
def money_text_parsed(t):
    listed = t.orders.select(
        "o_orderkey", F.concat(F.lit("$"), F.format_number("o_totalprice", 2)).alias("price"),
        (F.col("o_custkey") % 6 + 1).alias("people"),
    )
    amount = tx.parse_number(F.col("price"))
    return listed.select("o_orderkey", amount.alias("amount"), (amount / F.col("people")).alias("per_person"))


@query("T3", "T5", "T6", sql="""
    SELECT c_custkey, lpad((c_custkey * 37 % 100000)::VARCHAR, 5, '0') AS zip,
      'US-' || substr(lpad((c_custkey * 37 % 100000)::VARCHAR, 5, '0'), 1, 4) AS area FROM customer""")
def postal_codes_restored(t):
    zipped = t.customer.select("c_custkey", tx.pad_zip(F.col("c_custkey") * 37 % 100000).alias("zip"))
    return zipped.withColumn("area", tx.join_text("US-", tx.prefix(F.col("zip"), 4)))


@query("T4", sql="SELECT c_custkey, substr(c_name, 10) AS number FROM customer")
def customer_numbers(t):
    return t.customer.select("c_custkey", tx.drop_prefix(F.col("c_name"), 9).alias("number"))


SHIP_CODES = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 5}


@query("T7", "T8", "T9", "X1", sql="""
    SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS code,
      CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority ELSE 'others' END AS grouped,
      (o_orderstatus = 'F')::INT AS finished FROM orders""")
def recoded_orders(t):
    return t.orders.select(
        "o_orderkey",
        tx.recode(F.col("o_orderpriority"), SHIP_CODES).alias("code"),
        tx.keep_listed(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH"]).alias("grouped"),
        tx.flag(F.col("o_orderstatus"), "F").alias("finished"),
    )


# ---------------------------------------------------------------- dates


@query("D1", sql="""
    SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS day FROM orders""")
def mixed_date_layouts(t):
    layout = F.col("o_orderkey") % 3
    text = (
        F.when(layout == 0, F.date_format("o_orderdate", "MM/dd/yyyy"))
        .when(layout == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit("WEEK OF "), F.date_format("o_orderdate", "MMM dd, yyyy"), F.lit(" (B)")))
    )
    written = t.orders.select("o_orderkey", text.alias("written"))
    clean = tx.replace_pattern(tx.replace_literal(F.col("written"), "WEEK OF "), r" \(B\)")
    day = dt.parse_date(clean, ["MM/dd/yyyy", "yyyy-MM-dd", "MMM dd, yyyy"])
    return written.select("o_orderkey", dt.iso_text(day).alias("day"))


@query("D2", "D4", "D5", "D6", "D10", sql="""
    SELECT event_id, year(ts) AS year, month(ts) AS month, day(ts) AS day, hour(ts) AS hour, minute(ts) AS minute,
      isodow(ts) - 1 AS dayofweek, weekofyear(ts) AS week, strftime(ts, '%Y-%m') AS year_month,
      year(ts) || '/0' || quarter(ts) AS quarter FROM events""")
def event_date_parts(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id", *dt.date_parts(ts), dt.iso_week(ts).alias("week"),
        dt.year_month(ts).alias("year_month"), dt.quarter_label(ts).alias("quarter"),
    )


@query("D3", "D7", "D8", "D9", "D15", sql="""
    SELECT event_id, monthname(ts) AS month_name, CAST(ts AS DATE)::VARCHAR AS day,
      (CAST(ts AS DATE) + 1)::VARCHAR AS next_day, (CAST(ts AS DATE) - 7)::VARCHAR AS week_before,
      (month(ts) BETWEEN 5 AND 10)::INT AS warm, strftime(ts, '%H:%M:%S') AS wall_clock FROM events""")
def event_days(t):
    local = t.events.withColumn("ts", dt.drop_zone(F.col("ts")))
    day = dt.to_day(F.col("ts"))
    return local.select(
        "event_id", dt.month_name(F.col("ts")).alias("month_name"), dt.iso_text(day).alias("day"),
        dt.iso_text(dt.shift_days(day, 1)).alias("next_day"), dt.iso_text(dt.shift_days(day, -7)).alias("week_before"),
        dt.warm_season(day).alias("warm"), F.date_format("ts", "HH:mm:ss").alias("wall_clock"),
    )


# ---------------------------------------------------------------- gaps


@query("N1", sql=f"""
    SELECT l_orderkey, l_linenumber, coalesce(l_quantity, 0) AS l_quantity, coalesce(l_returnflag, '?') AS l_returnflag FROM {GAPPY_SQL}""")
def gaps_to_constant(t):
    filled = rp.fill_constant(gappy_lines(t), {"l_quantity": 0.0, "l_returnflag": "?"})
    return filled.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


@query("N2", sql=f"""
    SELECT l_orderkey, l_linenumber, round(coalesce(l_quantity, (SELECT avg(l_quantity) FROM {GAPPY_SQL})), 6) AS l_quantity,
      round(coalesce(l_extendedprice, (SELECT avg(l_extendedprice) FROM {GAPPY_SQL})), 4) AS l_extendedprice FROM {GAPPY_SQL}""")
def gaps_to_mean(t):
    filled = rp.fill_mean(gappy_lines(t), ["l_quantity", "l_extendedprice"])
    return filled.select(
        "l_orderkey", "l_linenumber", F.round("l_quantity", 6).alias("l_quantity"),
        F.round("l_extendedprice", 4).alias("l_extendedprice"),
    )


@query("N3", sql=f"""
    WITH m AS (SELECT l_returnflag AS mode FROM {GAPPY_SQL} WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT l_orderkey, l_linenumber, coalesce(l_returnflag, (SELECT mode FROM m)) AS l_returnflag FROM {GAPPY_SQL}""")
def gaps_to_mode(t):
    return rp.fill_mode(gappy_lines(t).select("l_orderkey", "l_linenumber", "l_returnflag"), "l_returnflag")


@query("N4", sql="""
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'N/A' ELSE c_mktsegment END AS c_mktsegment,
      CASE WHEN c_acctbal < 0 THEN 'N/A' ELSE c_name END AS c_name FROM customer""")
def blanks_to_marker(t):
    blanked = t.customer.select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_name")).alias("c_name"),
    )
    return rp.fill_blank(blanked, ["c_mktsegment", "c_name"])


@query("N5", "T3", "T5", "A8", sql="""
    WITH c AS (SELECT c_custkey, lpad((c_custkey * 37 % 100000)::VARCHAR, 5, '0') AS zip FROM customer),
    l AS (SELECT lpad((o_orderkey * 53 % 100000)::VARCHAR, 5, '0') AS lzip, max(o_totalprice) AS income,
            max(CASE WHEN o_orderstatus <> 'P' THEN o_custkey END)::DOUBLE AS households FROM orders GROUP BY 1),
    g AS (SELECT substr(lzip, 1, 4) AS pre, median(income) AS mi, median(households) AS mh FROM l
          WHERE income IS NOT NULL AND households IS NOT NULL GROUP BY 1)
    SELECT c_custkey, zip, round(coalesce(income, mi), 6) AS income, round(coalesce(households, mh), 6) AS households
    FROM c LEFT JOIN l ON zip = lzip LEFT JOIN g ON substr(zip, 1, 4) = pre""")
def income_from_lookup(t):
    customers = t.customer.select("c_custkey", tx.pad_zip(F.col("c_custkey") * 37 % 100000).alias("zip"))
    lookup = t.orders.groupBy(tx.pad_zip(F.col("o_orderkey") * 53 % 100000).alias("lzip")).agg(
        F.max("o_totalprice").alias("income"),
        F.max(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))).alias("households"),
    )
    filled = rp.fill_from_lookup(customers, lookup, "zip", "lzip", ["income", "households"])
    return co.round_columns(filled, 6, ["income", "households"])


@query("N6")
def gaps_from_regressions(t):
    gaps = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax", (F.col("l_partkey") % 100).cast("double").alias("size"),
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_suppkey") % 5 != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
    )
    filled = rp.fill_by_regression(gaps, ["l_quantity", "l_extendedprice"], ["l_discount", "l_tax", "size"])
    return co.round_columns(filled, 4, ["l_quantity", "l_extendedprice"])


@query("N6", sql="""
    WITH g AS (SELECT l_orderkey, l_linenumber, l_quantity AS x1, l_discount AS x2, CASE WHEN l_orderkey % 7 <> 0 THEN l_extendedprice END AS y
               FROM lineitem),
    m AS (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, covar_pop(x1, x1) AS s11, covar_pop(x1, x2) AS s12, covar_pop(x2, x2) AS s22,
      covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y FROM g WHERE y IS NOT NULL),
    b AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM m)
    SELECT l_orderkey, l_linenumber, round(coalesce(y, my + b1 * (x1 - m1) + b2 * (x2 - m2)), 3) AS l_extendedprice FROM g, b""")
def prices_from_two_predictors(t):
    gaps = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount",
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
    )
    filled = rp.fill_by_regression(gaps, ["l_extendedprice"], ["l_quantity", "l_discount"])
    return co.round_columns(filled.drop("l_quantity", "l_discount"), 3, ["l_extendedprice"])


@query("N7", sql="""
    WITH g AS (SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_orderkey % 7 <> 0 THEN l_extendedprice END AS y FROM lineitem),
    f AS (SELECT regr_slope(y, l_quantity) AS b, regr_intercept(y, l_quantity) AS a FROM g)
    SELECT l_orderkey, l_linenumber, round(coalesce(y, a + b * l_quantity), 4) AS l_extendedprice FROM g, f""")
def prices_from_quantity(t):
    gaps = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
    )
    filled = rp.fill_by_simple_regression(gaps, "l_extendedprice", "l_quantity")
    return co.round_columns(filled.drop("l_quantity"), 4, ["l_extendedprice"])
