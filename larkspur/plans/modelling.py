"""Fitted models on the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from larkspur.functions import gram as gm
from larkspur.functions.distributions import t_p_value_sql
from larkspur.models import classification as cl
from larkspur.models import extra_trees as et
from larkspur.models import features as fe
from larkspur.models import penalised as pn
from larkspur.models import regression as rg
from larkspur.operators import aggregates as ag
from larkspur.operators import columns as co
from larkspur.operators import rows as ro
from larkspur.operators import sampling as sa
from larkspur.operators import stats as st
from larkspur.operators.ranking import number_rows, top_n
from larkspur.plans.registry import query
from larkspur.session import checkpointed

PREDICTORS = ["l_extendedprice", "l_discount", "l_tax", "l_quantity"]
KEYS = ["l_orderkey", "l_linenumber"]


def charge_sides(t):
    """(train, test) with ``features`` and ``label`` = amount charged, split on the key."""
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    ready = fe.assemble(t.lineitem.select(*KEYS, *PREDICTORS, charge.alias("label")), PREDICTORS)
    return sa.split_by_key(ready.select(*KEYS, "features", "label"), KEYS, 0.8, seed=123)


@query("L1", "M8")
def elastic_net_errors(t):
    train, test = charge_sides(t)
    model = rg.elastic_net().fit(train)
    return st.error_metrics(model.transform(test), "label", "prediction")


@query("L2", sql="""
    WITH f AS (SELECT count(*) AS n, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a,
      regr_r2(l_extendedprice, l_quantity) AS r2, regr_syy(l_extendedprice, l_quantity) AS syy, regr_sxx(l_extendedprice, l_quantity) AS sxx,
      avg(l_quantity) AS mx FROM lineitem),
    e AS (SELECT *, syy * (1 - r2) / (n - 2) AS s2 FROM f)
    SELECT 0 AS position, '(intercept)' AS term, round(a, 3) AS estimate, round(sqrt(s2 * (1.0 / n + mx * mx / sxx)), 4) AS stderr,
      round(a / sqrt(s2 * (1.0 / n + mx * mx / sxx)), 4) AS t, n, round(r2, 6) AS r2,
      round(""" + t_p_value_sql("a / sqrt(s2 * (1.0 / n + mx * mx / sxx))", "n - 2") + """, 8) AS p_value FROM e
    UNION ALL SELECT 1, 'l_quantity', round(b, 3), round(sqrt(s2 / sxx), 4), round(b / sqrt(s2 / sxx), 4), n, round(r2, 6),
      round(""" + t_p_value_sql("b / sqrt(s2 / sxx)", "n - 2") + """, 8) FROM e""")
def price_regression_table(t):
    table = rg.ols_table(t.lineitem, "l_extendedprice", ["l_quantity"])
    return table.select(
        "position", "term", F.round("estimate", 3).alias("estimate"), F.round("stderr", 4).alias("stderr"),
        F.round("t", 4).alias("t"), "n", F.round("r2", 6).alias("r2"), F.round("p_value", 8).alias("p_value"),
    )


@query("L2", sql="""
    WITH f AS (SELECT count(*) AS n, regr_slope(l_discount, l_quantity) AS b, regr_intercept(l_discount, l_quantity) AS a,
      regr_r2(l_discount, l_quantity) AS r2, regr_syy(l_discount, l_quantity) AS syy, regr_sxx(l_discount, l_quantity) AS sxx,
      avg(l_quantity) AS mx FROM lineitem),
    e AS (SELECT *, sqrt(syy * (1 - r2) / (n - 2) / sxx) AS se FROM f)
    SELECT 'l_quantity' AS term, round(b, 9) AS estimate, round(b / se, 5) AS t, round(""" + t_p_value_sql("b / se", "n - 2") + """, 7) AS p_value FROM e""")
def discount_regression_slope(t):
    """A slope that is near zero, so that its p-value is not."""
    table = rg.ols_table(t.lineitem, "l_discount", ["l_quantity"]).where("position = 1")
    return table.select("term", F.round("estimate", 9).alias("estimate"), F.round("t", 5).alias("t"), F.round("p_value", 7).alias("p_value"))


@query("L2", sql="""
    WITH m AS (SELECT l_returnflag, avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_extendedprice) AS my,
      covar_pop(l_quantity, l_quantity) AS s11, covar_pop(l_quantity, l_discount) AS s12, covar_pop(l_discount, l_discount) AS s22,
      covar_pop(l_quantity, l_extendedprice) AS s1y, covar_pop(l_discount, l_extendedprice) AS s2y FROM lineitem GROUP BY 1),
    b AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM m)
    SELECT l_returnflag, round(my - b1 * m1 - b2 * m2, 2) AS intercept, round(b1, 3) AS quantity, round(b2, 1) AS discount FROM b""")
def price_regression_by_flag(t):
    table = rg.ols_table(t.lineitem, "l_extendedprice", ["l_quantity", "l_discount"], ["l_returnflag"])
    return table.groupBy("l_returnflag").agg(
        F.round(F.max(F.when(F.col("position") == 0, F.col("estimate"))), 2).alias("intercept"),
        F.round(F.max(F.when(F.col("position") == 1, F.col("estimate"))), 3).alias("quantity"),
        F.round(F.max(F.when(F.col("position") == 2, F.col("estimate"))), 1).alias("discount"),
    )


@query("L3", sql="""
    SELECT round(sum(l_quantity * l_extendedprice) / sum(l_quantity * l_quantity), 3) AS weight FROM lineitem""")
def price_gradient_descent(t):
    fit = rg.gradient_descent(t.lineitem, "l_extendedprice", ["l_quantity"], eta=0.001, n_iterations=200)
    return ro.append_results(t.spark, [{"weight": round(fit.weights[0], 3)}], "weight double")


def charged_lines(t):
    """Predictors and the amount charged, with a fold per order."""
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return t.lineitem.select(*KEYS, *PREDICTORS, charge.alias("charge"))


def order_fold():
    return F.pmod(F.col("l_orderkey"), F.lit(10))


@query("L3", sql="""
    WITH l AS (SELECT l_quantity / 50 AS x, l_extendedprice / 1000 AS y FROM lineitem),
    s AS (SELECT count(*)::DOUBLE AS n, sum(x * x) AS xx, sum(x * y) AS xy, sum(y * y) AS yy FROM l),
    w AS (SELECT CAST(k AS INTEGER) AS iteration, s.*, xy / xx * (1 - pow(1 - 0.05 * xx / n, k)) AS w FROM s, range(300) AS g(k))
    SELECT iteration, round((yy - 2 * w * xy + w * w * xx) / (2 * n), 6) AS cost FROM w""")
def price_descent_costs(t):
    """Cost before each of 300 steps."""
    lines = t.lineitem.select((F.col("l_quantity") / 50).alias("quantity"), (F.col("l_extendedprice") / 1000).alias("price"))
    fit = rg.gradient_descent(lines, "price", ["quantity"], eta=0.05, n_iterations=300)
    return co.round_columns(fit.history(t.spark), 6, ["cost"])


@query("L5", "L6", "R4", "F6", "O3", "O4")
def lasso_coefficients(t):
    """Ten folds, a hundred penalties: the two largest coefficients and the smallest one that are left."""
    model = pn.lasso_by_folds(charged_lines(t), "charge", PREDICTORS, order_fold())
    table = ro.keep_non_zero(rg.coefficient_table(t.lineitem, model, PREDICTORS), "coeff")
    ends = top_n(table, "coeff", 2, ["label"]).withColumn("end", F.lit("top"))
    return ends.unionByName(top_n(table, "coeff", 1, ["label"], largest=False).withColumn("end", F.lit("bottom")))


@query("L5", "R4", sql="""
    WITH f AS (SELECT l_orderkey % 10 AS fold, l_extendedprice / 1000 AS c0, l_discount AS c1, l_tax AS c2, l_quantity AS c3 FROM lineitem)
    SELECT fold, count(*)::DOUBLE AS n, i, j, round(CASE 10 * i + j WHEN 0 THEN covar_pop(c0, c0) WHEN 1 THEN covar_pop(c0, c1) WHEN 2 THEN covar_pop(c0, c2)
      WHEN 3 THEN covar_pop(c0, c3) WHEN 11 THEN covar_pop(c1, c1) WHEN 12 THEN covar_pop(c1, c2) WHEN 13 THEN covar_pop(c1, c3)
      WHEN 22 THEN covar_pop(c2, c2) WHEN 23 THEN covar_pop(c2, c3) ELSE covar_pop(c3, c3) END, 7) AS covariance
    FROM f, (SELECT a.i, b.j FROM range(4) a(i), range(4) b(j) WHERE a.i <= b.j) GROUP BY fold, i, j""")
def fold_covariances(t):
    """What the folds of a penalised regression are trained from."""
    lines = t.lineitem.select(order_fold().alias("fold"), (F.col("l_extendedprice") / 1000).alias("price"), "l_discount", "l_tax", "l_quantity")
    blocks = gm.cross_products(lines, ["price", "l_discount", "l_tax", "l_quantity"], ["fold"])
    return gm.product_cells(blocks, ["fold"]).withColumn("covariance", F.round("covariance", 7))


PENALTIES = [0.05, 0.5, 2.0, 8.0, 16.0, 40.0]

#: The closed form with one predictor: shrink the moment in units of the predictor's deviation.
LASSO_SQL = """
    WITH l AS (SELECT l_orderkey % 10 AS fold, l_extendedprice / 1000 AS u, l_extendedprice / 1000 * (1 - l_discount) AS v FROM lineitem),
    s AS (SELECT fold, count(*) AS n, sum(u) AS x, sum(v) AS y, sum(u * u) AS xx, sum(u * v) AS xy, sum(v * v) AS yy FROM l GROUP BY 1),
    a AS (SELECT sum(n) AS n, sum(x) AS x, sum(y) AS y, sum(xx) AS xx, sum(xy) AS xy, sum(yy) AS yy FROM s),
    d AS (SELECT s.fold, a.n - s.n AS n, a.x - s.x AS x, a.y - s.y AS y, a.xx - s.xx AS xx, a.xy - s.xy AS xy,
        s.n AS hn, s.x AS hx, s.y AS hy, s.xx AS hxx, s.xy AS hxy, s.yy AS hyy FROM s, a
      UNION ALL SELECT -1, n, x, y, xx, xy, n, x, y, xx, xy, yy FROM a),
    c AS (SELECT *, (xx - x * x / n) AS sxx, (xy - x * y / n) AS sxy FROM d),
    p AS (SELECT c.*, v.penalty, sqrt(sxx / n) AS sd FROM c, (VALUES (0.05::DOUBLE), (0.5), (2.0), (8.0), (16.0), (40.0)) AS v(penalty)),
    w AS (SELECT *, sign(sxy) * greatest(abs(sxy / (n * sd)) - penalty, 0) / sd AS weight FROM p),
    e AS (SELECT *, (hyy - 2 * weight * hxy + weight * weight * hxx - 2 * (y / n - weight * x / n) * (hy - weight * hx)) / hn + pow(y / n - weight * x / n, 2) AS mse FROM w),
    m AS (SELECT penalty, avg(mse) AS mse FROM e WHERE fold >= 0 GROUP BY 1)"""


def price_and_paid(t):
    """Price and price less discount of every line, in thousands."""
    price = F.col("l_extendedprice") / 1000
    return t.lineitem.select("l_orderkey", price.alias("price"), (price * (1 - F.col("l_discount"))).alias("paid"))


@query("L5", "L6", "R4", sql=LASSO_SQL + """
    SELECT m.penalty, round(m.mse, 6) AS mse, round(e.weight, 8) AS weight, m.penalty = (SELECT arg_min(penalty, mse) FROM m) AS chosen
    FROM m JOIN e ON e.penalty = m.penalty AND e.fold = -1""")
def one_predictor_lasso(t):
    """Held-out error and weight for every penalty, and which one ten folds choose."""
    lines = price_and_paid(t)
    fit = pn.lasso_by_folds(lines, "paid", ["price"], order_fold(), PENALTIES)
    errors = fit.errors.groupBy("penalty").agg(F.round(F.avg("mse"), 6).alias("mse"))
    path = pn.penalty_path(gm.gather(gm.cross_products(lines, ["price", "paid"]))[()], PENALTIES)
    weights = t.spark.createDataFrame([(p, round(float(w[0]), 8)) for p, w, _ in path], "penalty double, weight double")
    return errors.join(weights, "penalty").withColumn("chosen", F.col("penalty") == fit.penalty)


@query("L1", "M8", sql="""
    WITH l AS (SELECT l_extendedprice / 1000 AS u, l_extendedprice / 1000 * (1 - l_discount) AS v FROM lineitem),
    s AS (SELECT count(*) AS n, avg(u) AS x, avg(v) AS y, var_pop(u) AS vx, stddev_pop(u) AS sd, covar_pop(u, v) AS c, var_pop(v) AS vy FROM l),
    w AS (SELECT *, sign(c) * greatest(abs(c / sd) - 0.3 * 0.8, 0) / (1 + 0.3 * (1 - 0.8) / sqrt(vy)) / sd AS b FROM s)
    SELECT round(b, 8) AS weight, round(y - b * x, 7) AS intercept, round(vy - 2 * b * c + b * b * vx, 6) AS mse FROM w""")
def one_predictor_elastic_net(t):
    lines = price_and_paid(t)
    fit = pn.elastic_net_fit(lines, "paid", ["price"], 0.3, 0.8)
    errors = st.error_metrics(lines.select("paid", fit.score().alias("said")), "paid", "said")
    return errors.select(F.lit(round(fit.coefficients[0], 8)).alias("weight"), F.lit(round(fit.intercept, 7)).alias("intercept"), F.round("mse", 6).alias("mse"))


@query("L7", "L8", "L9", "L10", "L11", "L12", "L17", "U2", "O3", "F3")
def model_comparison(t):
    train, test = charge_sides(t)
    # The keys have done their work in the split; they would take room in the cache.
    train, test = (side.select("features", "label") for side in (train, test))
    results = rg.compare_models(train, test, {
        "forest": rg.random_forest(trees=10, depth=6),
        "randomised trees": rg.randomised_trees(trees=10, depth=6),
        "bagged trees": rg.bagged_trees(trees=10, depth=6),
        "boosted trees": rg.boosted_trees(max_iter=10, depth=4),
        "reweighted trees": lambda table: rg.boost_by_reweighting(table, rounds=4),
        "huber": rg.huber(),
    })
    return co.round_columns(results, 6)


@query("L9", "M8")
def extra_trees_errors(t):
    """Test error of trees with thresholds drawn at random."""
    train, test = charge_sides(t)
    model = et.extra_trees(train, trees=10, depth=8, seed=123)
    return co.round_columns(st.error_metrics(model.transform(test), "label", "prediction"), 6)


#: Ranges of the features over all rows: what the first node of a tree draws its threshold from.
RANGE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, min({c}) AS low, max({c}) AS high, sum({c}) AS total, count(*) AS n FROM lineitem" for c in PREDICTORS)


@query("L9", sql=f"""
    SELECT feature, true AS inside, n::BIGINT AS n FROM ({RANGE_SQL})""")
def extra_trees_first_splits(t):
    """Per feature, whether every first split of it lies inside its range, and the rows it was drawn from."""
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    ready = checkpointed(fe.assemble(t.lineitem.select(*PREDICTORS, charge.alias("label")), PREDICTORS).drop("features"))
    found = [et.splits(t.spark, et.extra_trees(fe.assemble(ready, [c]), trees=4, depth=1, seed=7), [c]) for c in PREDICTORS]
    roots = reduce(lambda a, b: a.unionByName(b), found).where("node = 0")
    ranges = ready.agg(*[F.struct(F.min(c).alias("low"), F.max(c).alias("high"), F.count(c).alias("n")).alias(c) for c in PREDICTORS])
    table = ranges.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("r")) for c in PREDICTORS])).alias("s"))
    table = table.select("s.feature", "s.r.low", "s.r.high", "s.r.n")
    judged = roots.join(table, "feature").groupBy("feature", "n").agg(F.bool_and((F.col("threshold") >= F.col("low")) & (F.col("threshold") < F.col("high"))).alias("inside"))
    return judged.select("feature", "inside", "n")


@query("L7")
def forest_importances(t):
    train, _ = charge_sides(t)
    model = rg.random_forest(trees=10, depth=6).fit(train)
    return cl.importances(train, model, PREDICTORS)


@query("L8", "L18", "M8")
def boosted_scores(t):
    train, test = charge_sides(t)
    model = rg.boosted_trees(max_iter=10, depth=4).fit(train)
    scored = rg.score_both(model, train, test)
    return scored.groupBy("side").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sqrt(F.avg(F.pow(F.col("label") - F.col("prediction"), 2))).alias("rmse"),
    )


DOC_FEATURES = ["chars", "words", "lines", "digits", "mean_word"]


def document_features(docs):
    """Numeric features of whole texts."""
    text = F.col("text")
    words = F.size(F.split(F.trim(text), r"\s+"))
    return docs.select(
        *[c for c in docs.columns if c != "text"],
        F.length(text).cast("double").alias("chars"),
        words.cast("double").alias("words"),
        (F.length(text) - F.length(F.translate(text, "\n", "")) + 1).cast("double").alias("lines"),
        (F.length(text) - F.length(F.translate(text, "0123456789", ""))).cast("double").alias("digits"),
        (F.length(text) / F.greatest(words, F.lit(1))).alias("mean_word"),
    )


def labelled_features(t):
    """Features of the labelled documents; the join comes first, so only their texts are read word by word."""
    return document_features(t.documents.select("doc_id", "lang", "text").join(t.labels, "doc_id"))


@query("L4", "E13", "M6")
def quality_logit_fit(t):
    known = labelled_features(t).select("quality", "lang", *[F.log1p(c).alias(c) for c in DOC_FEATURES])
    ready = fe.formula("quality ~ .").fit(known).transform(known).select("features", "label").persist()
    model = rg.logistic_glm().fit(ready)
    summary = model.summary
    measures = st.logit_fit_measures(model.transform(ready), "label", "prediction", rank=summary.rank)
    out = measures.withColumns({
        "deviance": F.lit(float(summary.deviance)), "null_deviance": F.lit(float(summary.nullDeviance))})
    fitted = checkpointed(co.round_columns(out, 6))
    ready.unpersist()
    return fitted


@query("L4", "L6")
def quality_logit_coefficients(t):
    """Estimate, standard error, z and p of every term; a row per coefficient."""
    known = labelled_features(t).select("quality", *[F.log1p(c).alias(c) for c in DOC_FEATURES])
    ready = fe.formula("quality ~ .").fit(known).transform(known).select("features", "label").persist()
    model = rg.logistic_glm().fit(ready)
    summary = model.summary
    names = [*DOC_FEATURES, "(intercept)"]
    estimates = [*model.coefficients.toArray().tolist(), model.intercept]
    rows = list(zip(names, estimates, summary.coefficientStandardErrors, summary.tValues, summary.pValues))
    ready.unpersist()
    table = t.spark.createDataFrame([(n, *map(float, v)) for n, *v in rows], "term string, estimate double, std_error double, z double, p_value double")
    return co.round_columns(table, 6)


def scored_prospects(t):
    """Unlabelled documents with the probability that they are good."""
    known = fe.assemble(labelled_features(t), DOC_FEATURES, invalid="error")
    model = cl.forest_classifier(trees=20, depth=5, labelCol="quality").fit(checkpointed(known.select("features", "quality")))
    unlabelled = t.documents.select("doc_id", "lang", "text").join(t.labels, "doc_id", "left_anti")
    fresh = fe.assemble(document_features(unlabelled), DOC_FEATURES, invalid="error")
    return model.transform(fresh).select("doc_id", "lang", cl.class_probability().alias("p"))


@query("L7", "L19", "L20", "A13")
def quality_prospects(t):
    # Everything above the threshold, however much that is.
    chosen = cl.likely(scored_prospects(t), "p", 0.65)
    return chosen.select("doc_id", "lang", F.round("p", 6).alias("p"), cl.cut(F.col("p")).alias("said"))


@query("L19", "L20")
def best_quality_prospects(t):
    # The thousand best, however likely they are.
    return cl.best_prospects(scored_prospects(t), "p", ["doc_id"], 1000).select("doc_id", "lang", F.round("p", 6).alias("p"))


#: A fixed score, so that both selections can be compared with SQL.
FIXED_P = "1 / (1 + exp(-(ln(1 + length(text)) - 6.5)))"
UNLABELLED = f"SELECT doc_id, round({FIXED_P}, 9) AS p FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"


def fixed_prospects(t):
    fresh = t.documents.join(t.labels, "doc_id", "left_anti")
    return fresh.select("doc_id", F.expr(f"round({FIXED_P}, 9)").alias("p"))


@query("L20", "O3", sql=f"SELECT * FROM ({UNLABELLED}) ORDER BY p DESC, doc_id LIMIT 1000")
def best_thousand_prospects(t):
    return cl.best_prospects(fixed_prospects(t), "p", ["doc_id"], 1000)


@query("L20", "F3", sql=f"SELECT * FROM ({UNLABELLED}) WHERE p > 0.65")
def likely_prospects(t):
    return cl.likely(fixed_prospects(t), "p", 0.65)


@query("L21")
def quality_shuffle_importance(t):
    known = checkpointed(labelled_features(t))
    ready = fe.assemble(known, DOC_FEATURES)
    model = cl.forest_classifier(trees=20, depth=5, labelCol="quality").fit(ready.select("features", "quality"))
    return cl.shuffle_importance(known, model, DOC_FEATURES, "quality", ["doc_id"])


@query("L21", "P15", sql="""
    SELECT count(*) AS n, count(*) AS positions, 1 AS first, count(*) AS last, sum(l_quantity)::DOUBLE AS quantity,
      round(sum(l_extendedprice), 2) AS price FROM lineitem""")
def shuffled_lines_keep_their_values(t):
    """Both columns after their values changed rows: every position is met once and no value is lost."""
    placed = checkpointed(number_rows(t.lineitem.select(*KEYS, "l_quantity", "l_extendedprice"), KEYS, name="_place"))
    moved = cl.shuffled_features(placed, ["l_quantity", "l_extendedprice"], placed.count(), seed=5)
    return moved.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("_place").alias("positions"), F.min("_place").cast("int").alias("first"), F.max("_place").alias("last"),
        F.sum(F.col("_moved")[0]).alias("quantity"), F.round(F.sum(F.col("_moved")[1]), 2).alias("price"))


@query("L21", "L7", "M7")
def quality_refit_on_best(t):
    """Forests on the two and three features whose shuffling costs most, and on all, with their test errors."""
    train, test = sa.split_by_key(checkpointed(labelled_features(t)), ["doc_id"], 0.8, seed=123)
    train, test = checkpointed(train), checkpointed(test)
    forest = cl.forest_classifier(trees=20, depth=5, labelCol="quality")
    fit = lambda table: forest.fit(table.withColumnRenamed("label", "quality"))
    named = lambda df: df.withColumn("label", F.col("quality").cast("double"))
    model = forest.fit(fe.assemble(train, DOC_FEATURES).select("features", "quality"))
    ranked = cl.shuffle_importance(train, model, DOC_FEATURES, "quality", ["doc_id"])
    return co.round_columns(cl.refit_on_best(named(train), named(test), fit, ranked, "label", [2, 3, len(DOC_FEATURES)]), 6)


@query("L13", "A13", "M7")
def embedding_network_report(t):
    ready = t.embeddings.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), "label")
    width = len(ready.first()["features"])
    classes = ready.agg(F.max("label")).first()[0] + 1
    train, test = sa.split_by_key(ready, ["vec_id"], 0.7, seed=5)
    model = cl.neural_classifier(width, classes, max_iter=15).fit(train.select("features", "label"))
    scored = model.transform(test).withColumn("said", F.col("prediction").cast("int"))
    return st.class_report(scored, "said", "label", list(range(classes)))


def embedding_vectors(t):
    return t.embeddings.select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )


@query("L14", "E5", "A9", "A13")
def embedding_clusters(t):
    scaled = fe.unit_deviation(embedding_vectors(t), "features", "scaled")
    _, found = cl.clusters(scaled, 5, seed=1, features="scaled")
    return ag.cross_table(found, "prediction", "label", ag.levels_of(t.embeddings, "label"))


@query("L15", "L16")
def embedding_elbow(t):
    scaled = fe.unit_deviation(embedding_vectors(t), "features", "scaled")
    return cl.elbow(scaled, range(2, 11), seed=1, features="scaled", silhouette=True)


@query("E10", "X5", "L14")
def embedding_components(t):
    vectors = embedding_vectors(t)
    _, found = cl.clusters(vectors, 5, seed=1)
    reduced = fe.fit_chain(fe.pca_stages("features", 2, "pca"), found).transform(found)
    return fe.spread_vector(reduced.select("vec_id", "prediction", "pca"), "pca", ["pca_1", "pca_2"])
