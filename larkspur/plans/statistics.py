"""Correlation, tests, fit measures and error metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions.distributions import normal_share_sql, t_p_value_sql
from larkspur.models.features import dummies
from larkspur.operators import aggregates as ag
from larkspur.operators import columns as co
from larkspur.operators import stats as st
from larkspur.plans.registry import query

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("A15", sql="SELECT round(corr(l_quantity, l_extendedprice), 6) AS corr FROM lineitem")
def quantity_price_correlation(t):
    return co.round_columns(ag.pearson(t.lineitem, "l_quantity", "l_extendedprice"), 6)


@query("A16", "P12", sql=" UNION ALL ".join(
    f"SELECT {i} AS i, {j} AS j, '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 6) + 0.0 AS corr FROM lineitem"
    for i, a in enumerate(MEASURES) for j, b in enumerate(MEASURES)
))
def measure_correlations(t):
    return ag.correlation_matrix(t.lineitem, MEASURES, digits=6)


@query("A17", "A18", "A19", sql=f"""
    WITH m AS ({" UNION ALL ".join(
        f"SELECT '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 6) AS corr FROM lineitem"
        for i, a in enumerate(MEASURES) for b in MEASURES[i + 1:])})
    SELECT var1, var2, corr FROM m ORDER BY abs(corr) DESC, var1, var2 LIMIT 3""")
def strongest_measure_pairs(t):
    return ag.strongest_pairs(ag.correlation_matrix(t.lineitem, MEASURES, digits=6), 3)


@query("A17", "A18", sql="""
    SELECT o_orderkey, variable, value FROM (
      UNPIVOT (SELECT o_orderkey, CASE WHEN o_custkey % 4 <> 0 THEN o_totalprice END AS o_totalprice,
        CAST(year(o_orderdate) AS DOUBLE) AS year FROM orders) ON o_totalprice, year INTO NAME variable VALUE value)""")
def orders_melted(t):
    wide = t.orders.select(
        "o_orderkey", F.when(F.col("o_custkey") % 4 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.year("o_orderdate").cast("double").alias("year"),
    )
    return ag.melt(wide, ["o_orderkey"], ["o_totalprice", "year"])


@query("A20", sql="SELECT round(avg(abs(c_acctbal - 4500)), 6) AS mean_abs FROM customer")
def mean_absolute_balance_gap(t):
    return co.round_columns(ag.mean_absolute(t.customer.select((F.col("c_acctbal") - 4500).alias("gap")), "gap"), 6)


@query("A21", sql="""
    SELECT p_partkey, round((p_retailprice - (SELECT min(p_retailprice) FROM part)) /
      ((SELECT max(p_retailprice) FROM part) - (SELECT min(p_retailprice) FROM part)), 9) AS p_retailprice,
      round((p_size - (SELECT min(p_size) FROM part)) / ((SELECT max(p_size) FROM part) - (SELECT min(p_size) FROM part)), 9) AS p_size
    FROM part""")
def parts_scaled(t):
    scaled = ag.min_max_scale(t.part.select("p_partkey", "p_retailprice", "p_size"), ["p_retailprice", "p_size"])
    return co.round_columns(scaled, 9, ["p_retailprice", "p_size"])


@query("M8", sql="""
    SELECT round(avg(pow(l_extendedprice - 1500 * l_quantity, 2)), 2) AS mse,
      round(sqrt(avg(pow(l_extendedprice - 1500 * l_quantity, 2))), 4) AS rmse,
      round(1 - avg(pow(l_extendedprice - 1500 * l_quantity, 2)) / var_pop(l_extendedprice), 6) AS r2 FROM lineitem""")
def fixed_price_errors(t):
    scored = t.lineitem.select("l_extendedprice", (F.col("l_quantity") * 1500).alias("predicted"))
    row = st.error_metrics(scored, "l_extendedprice", "predicted")
    return row.select(F.round("mse", 2).alias("mse"), F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"))


@query("M1", sql="""
    SELECT round(sqrt(avg(pow(l_extendedprice - 1500 * l_quantity, 2))) / stddev_samp(l_extendedprice), 6) AS ratio,
      sqrt(avg(pow(l_extendedprice - 1500 * l_quantity, 2))) / stddev_samp(l_extendedprice) < 0.8 AS under_threshold FROM lineitem""")
def fixed_price_error_ratio(t):
    scored = t.lineitem.select("l_extendedprice", (F.col("l_quantity") * 1500).alias("predicted"))
    return co.round_columns(st.error_ratio(scored, "l_extendedprice", "predicted", 0.8), 6)


@query("M2", sql="""
    SELECT l_orderkey, l_linenumber, round(250.5 + 1400 * l_quantity - 3000 * l_discount + 12.25 * l_tax, 4) AS score FROM lineitem""")
def fixed_linear_scores(t):
    score = st.linear_formula(250.5, {"l_quantity": 1400, "l_discount": -3000, "l_tax": 12.25})
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(score, 4).alias("score"))


@query("M3", sql="""
    WITH s AS (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS sd FROM orders)
    SELECT round(m, 4) AS mean, round(sd, 4) AS std, round((300000 - m) / sd, 6) AS z, round(""" + normal_share_sql("(300000 - m) / sd") + """, 9) AS share FROM s""")
def share_of_orders_below(t):
    row = st.share_below(t.orders, "o_totalprice", 300_000)
    return row.select(
        F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), F.round("z", 6).alias("z"), F.round("share", 9).alias("share")
    )


@query("M4", "D15", sql="""
    WITH g AS (SELECT (month(o_orderdate) BETWEEN 5 AND 10)::INT AS warm, o_totalprice AS x FROM orders),
    s AS (SELECT avg(x) FILTER (warm = 1) AS m1, avg(x) FILTER (warm = 0) AS m0,
      var_samp(x) FILTER (warm = 1) / count(*) FILTER (warm = 1) AS a, var_samp(x) FILTER (warm = 0) / count(*) FILTER (warm = 0) AS b,
      count(*) FILTER (warm = 1) AS n, count(*) FILTER (warm = 0) AS k FROM g)
    SELECT round(m1, 4) AS mean_first, round(m0, 4) AS mean_second, round((m1 - m0) / sqrt(a + b), 6) AS t,
      round(pow(a + b, 2) / (a * a / (n - 1) + b * b / (k - 1)), 4) AS df FROM s""")
def warm_season_test(t):
    from larkspur.functions.dates import warm_season

    seasons = t.orders.select(warm_season(F.col("o_orderdate")).alias("warm"), "o_totalprice")
    row = st.welch_test(seasons, "warm", "o_totalprice", 1, 0)
    return row.select(
        F.round("mean_first", 4).alias("mean_first"), F.round("mean_second", 4).alias("mean_second"),
        F.round("t", 6).alias("t"), F.round("df", 4).alias("df"),
    )


@query("M4", sql="""
    WITH g AS (SELECT (month(o_orderdate) BETWEEN 5 AND 10)::INT AS warm, o_totalprice AS x FROM orders),
    s AS (SELECT avg(x) FILTER (warm = 1) - avg(x) FILTER (warm = 0) AS gap,
      var_samp(x) FILTER (warm = 1) / count(*) FILTER (warm = 1) AS a, var_samp(x) FILTER (warm = 0) / count(*) FILTER (warm = 0) AS b,
      count(*) FILTER (warm = 1) AS n, count(*) FILTER (warm = 0) AS k FROM g),
    f AS (SELECT *, pow(a + b, 2) / (a * a / (n - 1) + b * b / (k - 1)) AS df, 1.959963984540054 AS z FROM s),
    -- The quantile by the expansion around the normal one: exact to more than nine digits at these sizes.
    q AS (SELECT *, sqrt(a + b) * (z + (pow(z, 3) + z) / (4 * df) + (5 * pow(z, 5) + 16 * pow(z, 3) + 3 * z) / (96 * df * df)
      + (3 * pow(z, 7) + 19 * pow(z, 5) + 17 * pow(z, 3) - 15 * z) / (384 * pow(df, 3))) AS half FROM f)
    SELECT round(""" + t_p_value_sql("gap / sqrt(a + b)", "df") + """, 8) AS p_value, round(gap - half, 3) AS ci_low, round(gap + half, 3) AS ci_high FROM q""")
def warm_season_p_value(t):
    from larkspur.functions.dates import warm_season

    seasons = t.orders.select(warm_season(F.col("o_orderdate")).alias("warm"), "o_totalprice")
    row = st.welch_test(seasons, "warm", "o_totalprice", 1, 0)
    return row.select(F.round("p_value", 8).alias("p_value"), F.round("ci_low", 3).alias("ci_low"), F.round("ci_high", 3).alias("ci_high"))


@query("M5", sql="""
    WITH c AS (SELECT corr(l_quantity, l_extendedprice) AS r12, corr(l_quantity, l_discount) AS r13, corr(l_extendedprice, l_discount) AS r23
               FROM lineitem),
    d AS (SELECT *, 1 + 2 * r12 * r13 * r23 - r12 * r12 - r13 * r13 - r23 * r23 AS det FROM c)
    SELECT 'l_quantity' AS predictor, round((1 - r23 * r23) / det, 6) AS vif FROM d
    UNION ALL SELECT 'l_extendedprice', round((1 - r13 * r13) / det, 6) FROM d
    UNION ALL SELECT 'l_discount', round((1 - r12 * r12) / det, 6) FROM d""")
def predictor_inflation(t):
    return co.round_columns(st.variance_inflation(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"]), 6)


SCORED_SQL = """(SELECT quality AS y, 1 / (1 + exp(-(0.8 - 0.0004 * n_chars + 0.5 * (lang = 'en')::INT))) AS p
    FROM labels JOIN documents USING (doc_id))"""


def scored_labels(t):
    """Labels with a probability from a fixed formula of document features."""
    joined = t.labels.join(t.documents.select("doc_id", "n_chars", "lang"), "doc_id")
    eta = 0.8 - 0.0004 * F.col("n_chars") + 0.5 * (F.col("lang") == "en").cast("int")
    return joined.select(F.col("quality").alias("y"), (1 / (1 + F.exp(-eta))).alias("p"))


# With two terms both have the same factor, and it is what the levels leave unexplained of the number:
# its weighted squares about the mean over those about the mean of its level.
@query("M5", "E3", sql=f"""
    WITH s AS (SELECT ln(1 + n_chars) AS x, lang, p * (1 - p) AS w FROM (SELECT n_chars, lang, 1 / (1 + exp(-(0.8 - 0.0004 * n_chars + 0.5 * (lang = 'en')::INT))) AS p
      FROM labels JOIN documents USING (doc_id)) WHERE lang IS NOT NULL),
    l AS (SELECT lang, sum(w) AS sw, sum(w * x) / sum(w) AS m FROM s GROUP BY lang),
    g AS (SELECT sum(w * x) / sum(w) AS m, count(DISTINCT lang) - 1 AS k FROM s),
    f AS (SELECT sum(w * pow(x - g.m, 2)) / sum(w * pow(x - l.m, 2)) AS v, any_value(g.k) AS k FROM s JOIN l USING (lang), g)
    SELECT 'lang' AS term, k::INT AS df, round(v, 6) AS gvif, round(pow(v, 1 / (2.0 * k)), 6) AS gvif_scaled FROM f
    UNION ALL SELECT 'log_chars', 1, round(v, 6), round(sqrt(v), 6) FROM f""")
def label_term_inflation(t):
    """Inflation of a factor and a number in a logit, weighted by its information matrix."""
    joined = t.labels.join(t.documents.select("doc_id", "n_chars", "lang"), "doc_id").where(F.col("lang").isNotNull())
    eta = 0.8 - 0.0004 * F.col("n_chars") + 0.5 * (F.col("lang") == "en").cast("int")
    p = 1 / (1 + F.exp(-eta))
    base = joined.select(F.log(1 + F.col("n_chars")).alias("log_chars"), "lang", (p * (1 - p)).alias("w"))
    flags = dummies(base, ["lang"], drop_first=True)
    terms = {"lang": [c for c in flags.columns if c.startswith("lang_")], "log_chars": ["log_chars"]}
    return co.round_columns(st.generalised_inflation(flags, terms, F.col("w")), 6)


@query("M6", "X4", sql=f"""
    WITH s AS (SELECT count(*)::DOUBLE AS n, avg(y) AS base, sum(CASE WHEN y = 1 THEN ln(p) ELSE ln(1 - p) END) AS ll,
      var_pop(ln(p / (1 - p))) * count(*) AS spread, sum(pow(y - p, 2)) AS residual, var_pop(y) * count(*) AS total,
      count(*) FILTER ((p > 0.5)::INT = y)::DOUBLE AS hits, greatest(sum(y), sum(1 - y))::DOUBLE AS majority FROM {SCORED_SQL}),
    l AS (SELECT *, n * (base * ln(base) + (1 - base) * ln(1 - base)) AS ll0 FROM s)
    SELECT round(1 - ll / ll0, 6) AS mcfadden, round(1 - (ll - 4) / ll0, 6) AS mcfadden_adjusted,
      round(1 - exp(2 * (ll0 - ll) / n), 6) AS cox_snell,
      round((1 - exp(2 * (ll0 - ll) / n)) / (1 - exp(2 * ll0 / n)), 6) AS nagelkerke,
      round(spread / (n * pi() * pi() / 3 + spread), 6) AS mckelvey_zavoina, round(1 - residual / total, 6) AS efron,
      round(hits / n, 6) AS count_r2, round((hits - majority) / (n - majority), 6) AS count_adjusted,
      round(6 - 2 * ll, 6) AS aic, round(6 - 2 * ll + 24 / (n - 4), 6) AS aic_corrected FROM l""")
def label_fit_measures(t):
    return co.round_columns(st.logit_fit_measures(scored_labels(t), "y", "p", rank=3), 6)


@query("M7", "A13", "L19", sql=f"""
    WITH s AS (SELECT y, (p > 0.5)::INT AS said FROM {SCORED_SQL}),
    c AS (SELECT k AS class, count(*) FILTER (y = k AND said = k)::DOUBLE AS hit, count(*) FILTER (said = k) AS said_n,
      count(*) FILTER (y = k) AS is_n, count(*) FILTER (y = said)::DOUBLE / count(*) AS accuracy
      FROM s, (VALUES (0), (1)) AS v(k) GROUP BY k)
    SELECT class, round(accuracy, 6) AS accuracy, round(hit / said_n, 6) AS precision, round(hit / is_n, 6) AS recall,
      round(2 * (hit / said_n) * (hit / is_n) / (hit / said_n + hit / is_n), 6) AS f_score FROM c""")
def label_class_report(t):
    cut = scored_labels(t).withColumn("said", (F.col("p") > 0.5).cast("int"))
    return co.round_columns(st.class_report(cut, "said", "y", [0, 1]), 6)


@query("A13", "L19", sql=f"""
    SELECT (p > 0.5)::INT AS said, count(*) FILTER (y = 0) AS "0", count(*) FILTER (y = 1) AS "1" FROM {SCORED_SQL} GROUP BY 1""")
def label_confusion(t):
    return ag.cross_table(scored_labels(t).withColumn("said", (F.col("p") > 0.5).cast("int")), "said", "y", [0, 1])
