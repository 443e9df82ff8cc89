"""Model properties on small tables: known coefficients, falling costs, encodings."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from larkspur.models import classification as cl
from larkspur.models import features as fe
from larkspur.models import penalised as pn
from larkspur.models import regression as rg
from larkspur.sources import sinks, synthetic
from larkspur.session import scratch_path


@pytest.fixture(scope="module")
def line(spark):
    return synthetic.linear_from_keys(spark.range(2000), ["id"], seed=3).persist()


def test_linear_sample_recovers_slope(spark, line):
    rows = {r.term: r for r in rg.ols_table(line, "y", ["x"]).collect()}
    assert rows["x"].estimate == pytest.approx(3.0, abs=0.1) and rows["(intercept)"].estimate == pytest.approx(2.5, abs=0.06)
    assert rows["x"].p_value < 1e-9
    drawn = synthetic.linear_sample(spark, 100, 0)
    assert drawn.count() == 100 and drawn.where("x < 0 OR x >= 1").count() == 0


def test_gradient_descent_equals_step_by_step(line):
    data = np.array([(r.x, r.y) for r in line.select("x", "y").collect()])
    x, y = data[:, :1], data[:, 1]
    w, costs = np.zeros(1), []
    for _ in range(50):
        gap = x @ w - y
        costs.append(float(gap @ gap / (2 * len(y))))
        w = w - 0.05 / len(y) * (x.T @ gap)
    fit = rg.gradient_descent(line, "y", ["x"], eta=0.05, n_iterations=50)
    assert fit.weights == pytest.approx(list(w)) and fit.costs == pytest.approx(costs)
    assert all(a >= b for a, b in zip(fit.costs, fit.costs[1:]))
    early = rg.gradient_descent(line, "y", ["x"], eta=0.05, n_iterations=5000, tolerance=1e-4)
    assert len(early.costs) < 5000


def test_dummies(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "i int, s string")
    assert fe.dummies(df, ["s"]).columns == ["i", "s_a", "s_b"]
    assert [tuple(r) for r in fe.dummies(df, ["s"], drop_first=True).orderBy("i").collect()] == [(1, 1), (2, 0), (3, 0)]


def test_preparation_unseen_level_and_reload(spark):
    train = spark.createDataFrame([(1.0, "f", 5.0), (3.0, "m", 6.0), (None, None, 7.0), (5.0, "f", 8.0)], "x double, sex string, age double")
    test = spark.createDataFrame([(2.0, "z", 1.0), (None, "m", 2.0), (9.0, None, 3.0)], "x double, sex string, age double")
    fitted = fe.preparation(train, ["x"], ["sex"], ["age"]).fit(train)
    again = sinks.load_fitted(sinks.save_fitted(fitted, scratch_path(spark, "preparation")))
    got = [list(r[0]) for r in again.transform(test).select(vector_to_array("features")).collect()]
    # unseen level: zeros; missing number: the train mean 3 -> 0.5; missing level: the mode 'f', which is the dropped first level
    assert got == [[0.25, 0.0, 1.0], [0.5, 1.0, 2.0], [2.0, 0.0, 3.0]]


def test_truncated_svd_and_centred_pca(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 3)) + [3, 0, 1]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    got = np.array([(r.svd_1, r.svd_2) for r in fe.truncated_svd(df, ["a", "b", "c"], 2).collect()])
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(x @ vt[:2].T), atol=1e-8)
    ready = fe.assemble(df, ["a", "b", "c"])
    scores = np.array([r[0][0] for r in fe.fit_chain(fe.pca_stages("features", 1, "p"), ready).transform(ready).select(vector_to_array("p")).collect()])
    assert abs(scores.mean()) < 1e-9


@pytest.fixture(scope="module")
def bent(spark):
    base = spark.range(600).select(F.col("id"), (F.col("id") % 20).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    return fe.assemble(base.withColumn("label", F.when(F.col("a") > 10, 50.0).otherwise(10.0) + F.col("b")), ["a", "b"]).persist()


def test_models_compared(spark, bent):
    train, test = bent.where("id % 5 <> 0"), bent.where("id % 5 = 0")
    results = {r.model: r.test_r2 for r in rg.compare_models(train, test, {
        "forest": rg.random_forest(5, 5), "bagged": rg.bagged_trees(5, 5), "random": rg.randomised_trees(5, 5),
        "boosted": rg.boosted_trees(3, 3), "committee": lambda t: rg.boost_by_reweighting(t, rounds=3), "huber": rg.huber(),
    }).collect()}
    assert all(results[m] > 0.9 for m in ("forest", "bagged", "boosted", "committee")) and results["huber"] > 0.4
    assert results["random"] > 0.5


def test_committee_predicts_weighted_median(spark, bent):
    committee = rg.boost_by_reweighting(bent, rounds=3)
    out = bent
    for i, tree in enumerate(committee.trees):
        out = tree.setPredictionCol(f"t{i}").transform(out)
    out = committee.transform(out.select("id", "features", "label", *[f"t{i}" for i in range(len(committee.trees))]))
    for r in out.limit(50).collect():
        answers = sorted((r[f"t{i}"], v) for i, v in enumerate(committee.votes))
        total, half = 0.0, sum(committee.votes) / 2
        for answer, vote in answers:
            total += vote
            if total >= half:
                break
        assert r.prediction == answer


def test_lasso_finds_the_used_columns(spark):
    df = synthetic.linear_from_keys(spark.range(500), ["id"], seed=9).withColumn("noise", F.pmod(F.xxhash64("id"), F.lit(100)) / 100.0)
    model = pn.lasso_by_folds(df, "y", ["x", "noise"], F.pmod("id", F.lit(3)), [0.05, 5.0])
    table = {r.label: r.coeff for r in rg.coefficient_table(df, model, ["x", "noise"]).collect()}
    assert table["x"] > 2 and abs(table["noise"]) < 0.1


def test_shuffling_the_used_column_hurts(spark):
    df = spark.range(400).select(
        "id", (F.col("id") % 10).cast("double").alias("used"), (F.col("id") % 3).cast("double").alias("idle"),
        (F.col("id") % 10 > 4).cast("double").alias("y"),
    )
    model = cl.forest_classifier(5, 3, labelCol="y").fit(fe.assemble(df, ["used", "idle"]))
    loss = {r.feature: r.accuracy_loss for r in cl.shuffle_importance(df, model, ["used", "idle"], "y", ["id"]).collect()}
    assert loss["used"] > 0.3 and abs(loss["idle"]) < 0.05


def test_elbow_falls(spark):
    df = fe.assemble(spark.range(120).select((F.col("id") % 4 * 10 + F.col("id") / 500).alias("a"), (F.col("id") % 2).cast("double").alias("b")), ["a", "b"])
    rows = cl.elbow(df, range(2, 5), silhouette=True).orderBy("k").collect()
    assert rows[0].cost > rows[1].cost > rows[2].cost and rows[2].silhouette > 0.9


def test_logit_glm_matches_fit_measures(spark):
    from larkspur.operators.stats import logit_fit_measures

    df = spark.range(400).select(((F.col("id") % 20) / 10.0).alias("x"), (F.pmod(F.xxhash64("id"), F.lit(20)) < F.col("id") % 20).cast("double").alias("label"))
    ready = fe.formula("label ~ x").fit(df).transform(df)
    model = rg.logistic_glm().fit(ready)
    row = logit_fit_measures(model.transform(ready), "label", "prediction", rank=2).first()
    assert row.aic == pytest.approx(model.summary.aic, rel=1e-6)
    assert row.mcfadden == pytest.approx(1 - model.summary.deviance / model.summary.nullDeviance, rel=1e-6)


def test_collect_small_refuses_large_results(spark):
    assert len(sinks.collect_small(spark.range(5))) == 5
    with pytest.raises(ValueError):
        sinks.collect_small(spark.range(50), limit=10)


def test_patients_table(spark):
    assert synthetic.patients(spark).count() == 442
