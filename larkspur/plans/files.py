"""Delimited files written from the tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions.dates import iso_text
from larkspur.operators import aggregates as ag
from larkspur.plans.registry import query
from larkspur.session import scratch_path
from larkspur.sources import delimited as de
from larkspur.sources import sinks as sk
from larkspur.sources import synthetic as sy


@query("S1", "K1", sql="SELECT doc_id, lang, source, md5(text) AS digest, length(text) AS chars FROM documents")
def documents_through_csv(t):
    # Whole texts with quotes, commas and line breaks inside the field.
    path = sk.write_csv(t.documents.select("doc_id", "lang", "source", "text"), scratch_path(t.spark, "documents"))
    back = de.read_csv(t.spark, path, "doc_id long, lang string, source string, text string", multi_line=True)
    return back.select("doc_id", "lang", "source", F.md5("text").alias("digest"), F.length("text").alias("chars"))


@query("S2", "K1", sql="SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS day, o_totalprice, o_orderpriority FROM orders")
def orders_through_csv(t):
    path = sk.write_csv(
        t.orders.select("o_orderkey", iso_text(F.col("o_orderdate")).alias("day"), "o_totalprice", "o_orderpriority"),
        scratch_path(t.spark, "orders"),
    )
    back = de.read_csv(t.spark, path, "o_orderkey long, day date, o_totalprice double, o_orderpriority string")
    return back.withColumn("day", iso_text(F.col("day")))


@query("K1", sql="""
    SELECT row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS row_index, c_custkey, c_acctbal FROM customer""")
def customers_through_indexed_csv(t):
    path = sk.write_csv(
        t.customer.select("c_custkey", "c_acctbal"), scratch_path(t.spark, "customers"),
        index_order=["c_acctbal", "c_custkey"],
    )
    return de.read_csv(t.spark, path, "row_index long, c_custkey long, c_acctbal double")


@query("S3", sql="""
    SELECT CAST(o_orderdate AS DATE)::VARCHAR AS week, round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY 1""")
def daily_amounts_below_preamble(t):
    daily = t.orders.groupBy(iso_text(F.col("o_orderdate")).alias("week")).agg(
        F.format_string("%.2f", F.sum("o_totalprice")).alias("amount")
    )
    titles = t.spark.range(1).select(F.explode(F.array(F.lit("Category: all"), F.lit("Week"))).alias("week"), F.lit("Orders: (all)").alias("amount"))
    path = sk.write_csv(titles.unionByName(daily), scratch_path(t.spark, "daily"), header=False)
    back = de.read_after_preamble(t.spark, path, "week", ["amount"], preamble=["Category: all", "Week"])
    return back.withColumn("week", iso_text(F.col("week")))


@query("S4", sql="SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal >= 0")
def suppliers_without_comment_lines(t):
    # Suppliers in debt are written as comment lines.
    key = F.col("s_suppkey").cast("string")
    lines = t.supplier.select(F.when(F.col("s_acctbal") < 0, F.concat(F.lit("#"), key)).otherwise(key).alias("k"), "s_name")
    path = scratch_path(t.spark, "suppliers")
    lines.select(F.concat_ws(",", "k", "s_name").alias("value")).write.text(path)
    return de.read_csv(t.spark, path, "s_suppkey long, s_name string", header=False, comment="#")


@query("S5", sql="SELECT p_partkey, p_name, p_retailprice FROM part")
def parts_through_tsv(t):
    path = sk.write_csv(t.part.select("p_partkey", "p_name", "p_retailprice"), scratch_path(t.spark, "parts"), sep="\t")
    return de.read_tsv(t.spark, path, "p_partkey long, p_name string, p_retailprice double")


@query("S6", sql="""SELECT p_partkey::VARCHAR AS "V1", p_name AS "V2", p_size::VARCHAR AS "V3" FROM part""")
def parts_through_quoted_words(t):
    path = scratch_path(t.spark, "words")
    t.part.select(F.concat(
        F.col("p_partkey").cast("string"), F.lit('   "'), F.col("p_name"), F.lit('" '), F.col("p_size").cast("string")
    ).alias("value")).write.text(path)
    return de.read_quoted_words(t.spark, path, 3)


@query("S7", sql="""
    SELECT c_custkey, c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) AS INTEGER) AS c_mktsegment_code FROM customer""")
def segment_categories(t):
    return de.as_categories(t.customer.select("c_custkey", "c_mktsegment"), ["c_mktsegment"])


@query("S8")
def linear_sample_from_keys(t):
    sample = sy.linear_from_keys(t.lineitem, ["l_orderkey", "l_linenumber"], seed=0)
    return sample.agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept")
    )


@query("K4", "A1", sql="SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY 1")
def collected_status_counts(t):
    local = sk.collect_small(ag.group_count(t.orders, ["o_orderstatus"], "orders"))
    return t.spark.createDataFrame(local, "o_orderstatus string, orders long")
