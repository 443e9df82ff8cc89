"""Feature preparation on the tables."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.sql import functions as F

from larkspur.models import features as fe
from larkspur.operators import aggregates as ag
from larkspur.operators import columns as co
from larkspur.plans.registry import query
from larkspur.session import scratch_path
from larkspur.sources import sinks as sk

NUMERIC = ["l_quantity", "l_discount", "l_tax"]


@query("E2", sql="""
    SELECT c_custkey, (c_mktsegment = 'AUTOMOBILE')::INT AS "c_mktsegment_AUTOMOBILE", (c_mktsegment = 'BUILDING')::INT AS "c_mktsegment_BUILDING",
      (c_mktsegment = 'FURNITURE')::INT AS "c_mktsegment_FURNITURE", (c_mktsegment = 'HOUSEHOLD')::INT AS "c_mktsegment_HOUSEHOLD",
      (c_mktsegment = 'MACHINERY')::INT AS "c_mktsegment_MACHINERY" FROM customer""")
def segment_dummies(t):
    return fe.dummies(t.customer.select("c_custkey", "c_mktsegment"), ["c_mktsegment"])


@query("E3", sql="""
    SELECT o_orderkey, coalesce((s = 'O')::INT, 0) AS "s_O", coalesce((s = 'P')::INT, 0) AS "s_P"
    FROM (SELECT o_orderkey, CASE WHEN o_custkey % 9 <> 0 THEN o_orderstatus END AS s FROM orders)""")
def status_dummies_without_first(t):
    gaps = t.orders.select("o_orderkey", F.when(F.col("o_custkey") % 9 != 0, F.col("o_orderstatus")).alias("s"))
    return fe.dummies(gaps, ["s"], drop_first=True)


@query("E1", "E5", sql="""
    SELECT l_orderkey, l_linenumber, round(l_quantity / (SELECT stddev_samp(l_quantity) FROM lineitem), 6) AS l_quantity,
      round(l_discount / (SELECT stddev_samp(l_discount) FROM lineitem), 6) AS l_discount,
      round(l_tax / (SELECT stddev_samp(l_tax) FROM lineitem), 6) AS l_tax FROM lineitem""")
def standardised_lines(t):
    vectors = fe.assemble(t.lineitem.select("l_orderkey", "l_linenumber", *NUMERIC), NUMERIC, "raw").drop(*NUMERIC)
    scaled = fe.unit_deviation(vectors, "raw", "scaled").drop("raw")
    return co.round_columns(fe.spread_vector(scaled, "scaled", NUMERIC), 6)


@query("E6", "E7", "R1", "K2", sql="""
    WITH s AS (SELECT *, (l_orderkey * 7919 + 13) % 10007 < 8005.6 AS is_train FROM lineitem),
    r AS (SELECT min(l_quantity) AS ql, max(l_quantity) AS qh, min(l_discount) AS dl, max(l_discount) AS dh,
            min(l_tax) AS tl, max(l_tax) AS th FROM s WHERE is_train)
    SELECT l_orderkey, l_linenumber, round((l_quantity - ql) / (qh - ql), 6) AS l_quantity,
      round((l_discount - dl) / (dh - dl), 6) AS l_discount, round((l_tax - tl) / (th - tl), 6) AS l_tax
    FROM s, r WHERE NOT is_train""")
def scaled_test_lines(t):
    side = t.lineitem.withColumn("is_train", F.expr("(l_orderkey * 7919 + 13) % 10007 < 8005.6"))
    slim = side.select("l_orderkey", "l_linenumber", *NUMERIC, "is_train")
    fitted = Pipeline(stages=[
        VectorAssembler(inputCols=NUMERIC, outputCol="raw"), MinMaxScaler(inputCol="raw", outputCol="scaled"),
    ]).fit(slim.where("is_train"))
    reloaded = sk.load_fitted(sk.save_fitted(fitted, scratch_path(t.spark, "scaler")))
    scaled = reloaded.transform(slim.where("NOT is_train")).select("l_orderkey", "l_linenumber", "scaled")
    return co.round_columns(fe.spread_vector(scaled, "scaled", NUMERIC), 6)


PREPARED_SQL = """
    WITH g AS (SELECT o_orderkey, CASE WHEN o_custkey % 9 <> 0 THEN o_totalprice END AS amount, month(o_orderdate) AS month,
        CASE WHEN o_custkey % 13 <> 0 THEN o_orderpriority END AS priority, year(o_orderdate)::DOUBLE AS year,
        (o_orderkey * 7919 + 13) % 10007 < 8005.6 AS is_train FROM orders),
    n AS (SELECT * FROM g WHERE is_train AND (priority IS NULL OR priority <> '5-LOW')),
    r AS (SELECT avg(amount) AS mean, min(amount) AS lo, max(amount) AS hi, min(month) AS ml, max(month) AS mh FROM n),
    m AS (SELECT priority AS mode FROM n WHERE priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
    f AS (SELECT *, coalesce(priority, mode) AS level FROM g, r, m WHERE NOT is_train)
    SELECT o_orderkey, priority, round((coalesce(amount, mean) - lo) / (hi - lo), 6) AS numeric__amount,
      round((month - ml) / (mh - ml), 6) AS numeric__month, (level = '2-HIGH')::INT::DOUBLE AS priority_2,
      (level = '3-MEDIUM')::INT::DOUBLE AS priority_3, (level = '4-NOT SPECIFIED')::INT::DOUBLE AS priority_4, year FROM f"""


def prepared_input(t):
    """Order features with gaps in a numeric and in a text column: (train, test)."""
    gaps = t.orders.select(
        "o_orderkey", F.when(F.col("o_custkey") % 9 != 0, F.col("o_totalprice")).alias("amount"),
        F.month("o_orderdate").cast("double").alias("month"),
        F.when(F.col("o_custkey") % 13 != 0, F.col("o_orderpriority")).alias("priority"),
        F.year("o_orderdate").cast("double").alias("year"),
    )
    is_train = F.expr("(o_orderkey * 7919 + 13) % 10007 < 8005.6")
    return gaps.where(is_train), gaps.where(~is_train)


@query("E4", "E7", "E8", "N2", "N3", sql=PREPARED_SQL)
def prepared_orders(t):
    train, test = prepared_input(t)
    # The level missing from training is unseen when the test rows are encoded.
    train = train.where("priority IS NULL OR priority <> '5-LOW'")
    fitted = fe.preparation(train, ["amount", "month"], ["priority"], ["year"]).fit(train)
    names = ["numeric__amount", "numeric__month", "priority_2", "priority_3", "priority_4", "year"]
    out = fitted.transform(test).select("o_orderkey", "priority", "features")
    return co.round_columns(fe.spread_vector(out, "features", names), 6)


@query("E9", "E10", "E11")
def reduced_lines(t):
    slim = t.lineitem.select("l_orderkey", "l_linenumber", *NUMERIC, "l_extendedprice")
    columns = [*NUMERIC, "l_extendedprice"]
    scaled = [
        VectorAssembler(inputCols=columns, outputCol="raw"), MinMaxScaler(inputCol="raw", outputCol="scaled"),
        *fe.pca_stages("scaled", 1, "pca"),
    ]
    reduced = fe.fit_chain(scaled, slim).transform(slim)
    spread = fe.spread_vector(reduced.drop("raw", "pca__centred"), "scaled", [f"m_{c}" for c in columns])
    both = fe.truncated_svd(spread, [f"m_{c}" for c in columns], 2)
    joined = fe.side_by_side(["pca", "svd_1", "svd_2"]).transform(both).select("l_orderkey", "l_linenumber", "features")
    return co.round_columns(fe.spread_vector(joined, "features", ["pca_1", "svd_1", "svd_2"]), 6)


@query("E12", "X3", sql="""
    SELECT l_orderkey, l_linenumber, l_quantity + l_tax AS quantity_tax, l_extendedprice - l_discount AS price_discount FROM lineitem""")
def user_function_steps(t):
    steps = [
        fe.expression_step(quantity_tax="l_quantity + l_tax"),
        fe.expression_step(price_discount="l_extendedprice - l_discount"),
    ]
    out = fe.fit_chain(steps, t.lineitem).transform(t.lineitem)
    return out.select("l_orderkey", "l_linenumber", "quantity_tax", "price_discount")


@query("E13", sql="""
    SELECT o_orderkey, o_totalprice AS label, (o_orderstatus = 'P')::INT::DOUBLE AS p, (o_orderstatus = 'O')::INT::DOUBLE AS o,
      month(o_orderdate)::DOUBLE AS month FROM orders""")
def formula_features(t):
    base = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", F.month("o_orderdate").alias("month"))
    out = fe.formula("o_totalprice ~ o_orderstatus + month").fit(base).transform(base)
    return fe.spread_vector(out.select("o_orderkey", "label", "features"), "features", ["p", "o", "month"])


@query("E2", "A16", "A19", sql="""
    WITH b AS (SELECT p_brand, count(*) AS nb FROM part GROUP BY 1), c AS (SELECT p_type, count(*) AS nc FROM part GROUP BY 1),
    k AS (SELECT p_brand, p_type, count(*) AS nk FROM part GROUP BY 1, 2), n AS (SELECT count(*)::DOUBLE AS n FROM part)
    SELECT 'p_brand_' || p_brand AS var1, 'p_type_' || p_type AS var2,
      round((n * coalesce(nk, 0) - nb * nc) / sqrt(nb * (n - nb)) / sqrt(nc * (n - nc)), 6) AS corr
    FROM b CROSS JOIN c CROSS JOIN n LEFT JOIN k USING (p_brand, p_type)""")
def part_dummy_correlations(t):
    """Brands against types, from the correlations of all dummy columns of parts in one pass."""
    sized = t.part.select("p_brand", "p_type", F.col("p_size").cast("string").alias("p_size"))
    cells = ag.correlation_matrix(fe.dummies(sized, ["p_brand", "p_type", "p_size"]), digits=6)
    return cells.where(F.col("var1").startswith("p_brand_") & F.col("var2").startswith("p_type_")).select("var1", "var2", "corr")


@query("E11", sql="""
    WITH g AS (SELECT sum(p_size::DOUBLE * p_size) AS a, sum(p_size * p_retailprice / 100) AS b, sum(p_retailprice * p_retailprice / 10000) AS c FROM part),
    e AS (SELECT *, (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS top, (a + c) / 2 - sqrt(pow((a - c) / 2, 2) + b * b) AS low FROM g),
    v AS (SELECT b / sqrt(b * b + pow(top - a, 2)) AS x1, (top - a) / sqrt(b * b + pow(top - a, 2)) AS y1,
      b / sqrt(b * b + pow(low - a, 2)) AS x2, (low - a) / sqrt(b * b + pow(low - a, 2)) AS y2 FROM e),
    w AS (SELECT *, CASE WHEN abs(x1) >= abs(y1) THEN sign(x1) ELSE sign(y1) END AS s1, CASE WHEN abs(x2) >= abs(y2) THEN sign(x2) ELSE sign(y2) END AS s2 FROM v)
    SELECT p_partkey, round(s1 * (x1 * p_size + y1 * p_retailprice / 100), 6) AS svd_1, round(s2 * (x2 * p_size + y2 * p_retailprice / 100), 6) AS svd_2 FROM part, w""")
def two_column_svd(t):
    parts = t.part.select("p_partkey", F.col("p_size").cast("double").alias("size"), (F.col("p_retailprice") / 100).alias("price"))
    return co.round_columns(fe.truncated_svd(parts, ["size", "price"], 2).select("p_partkey", "svd_1", "svd_2"), 6)


@query("E10", sql="""
    WITH g AS (SELECT avg(p_size) AS mx, avg(p_retailprice / 100) AS my, var_pop(p_size) AS a, covar_pop(p_size, p_retailprice / 100) AS b, var_pop(p_retailprice / 100) AS c FROM part),
    e AS (SELECT *, (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS top FROM g)
    SELECT p_partkey, round(abs(b * (p_size - mx) + (top - a) * (p_retailprice / 100 - my)) / sqrt(b * b + pow(top - a, 2)), 6) AS distance FROM part, e""")
def first_component_distance(t):
    """How far a part lies along the first principal component, without the component's arbitrary sign."""
    parts = fe.assemble(t.part.select("p_partkey", "p_size", (F.col("p_retailprice") / 100).alias("price")), ["p_size", "price"])
    scored = fe.fit_chain(fe.pca_stages("features", 1, "pca"), parts).transform(parts)
    return fe.spread_vector(scored.select("p_partkey", "pca"), "pca", ["c"]).select("p_partkey", F.round(F.abs("c"), 6).alias("distance"))
