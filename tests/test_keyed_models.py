"""Random splits, keyed shuffles, inflation of terms and sparse changepoints on small tables with known answers."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.models import classification as cl
from larkspur.models import extra_trees as et
from larkspur.models import features as fe
from larkspur.models import regression as rg
from larkspur.operators import stats as st
from larkspur.series import trend as tr

START = dt.date(2015, 1, 5)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 97, 256, 257, 1000, 5003])
def test_positions_are_met_once(spark, n):
    rows = spark.range(1, n + 1).select("id", *[cl.scattered(F.col("id"), n, k).alias(f"p{k}") for k in (1, 2)])
    got = rows.toPandas()
    assert sorted(got.p1) == sorted(got.p2) == list(range(1, n + 1))
    if n > 90:
        assert (got.p1 != got.p2).mean() > 0.9 and (got.p1 != got.id).mean() > 0.9
        assert abs(np.corrcoef(got.id, got.p1)[0, 1]) < 4 / n**0.5


def test_importance_of_one_deciding_feature(spark):
    df = spark.range(600).select(
        "id", (F.col("id") % 7).cast("double").alias("a"), F.rand(3).alias("b"), F.when(F.col("id") % 5 != 0, 1.0).alias("c"),
        (F.col("id") % 7 > 3).cast("int").alias("y")).withColumn("c", F.coalesce("c", F.lit(0.0)))
    model = cl.forest_classifier(trees=5, depth=4, labelCol="y").fit(fe.assemble(df, ["a", "b", "c"]))
    ranked = cl.shuffle_importance(df, model, ["a", "b", "c"], "y", ["id"])
    got = {r.feature: r.accuracy_loss for r in ranked.collect()}
    assert 0.3 < got["a"] < 0.7 and abs(got["b"]) < 0.05 and abs(got["c"]) < 0.05
    fit = lambda t: cl.forest_classifier(trees=5, depth=4, labelCol="label").fit(t)
    named = df.withColumn("label", F.col("y").cast("double"))
    rows = cl.refit_on_best(named, named, fit, ranked, "label", [1, 3]).collect()
    assert [(r.n_features, r.names.split(",")[0]) for r in rows] == [(1, "a"), (3, "a")] and rows[0].error_rate == 0
    empty = cl.shuffle_importance(df.limit(0), model, ["a", "b", "c"], "y", ["id"]).collect()
    assert [r.accuracy_loss for r in empty] == [None] * 3


def test_shuffled_features_keep_nulls_and_repeats(spark):
    placed = spark.createDataFrame([(i, None if i % 3 == 0 else float(i % 4)) for i in range(1, 61)], "_place long, v double")
    moved = cl.shuffled_features(placed, ["v", "v"], 60, seed=1)
    values = [r["_moved"] for r in moved.collect()]
    key = lambda x: (x is None, x or 0)
    want = sorted((r.v for r in placed.collect()), key=key)
    assert all(sorted((v[i] for v in values), key=key) == want for i in (0, 1)) and any(v[0] != v[1] for v in values)
    text = moved._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert text.count("Exchange hashpartitioning") == 1 and "EvalPython" not in text and "InPandas" not in text


def _points(spark, n=400, parts=3):
    rng = np.random.default_rng(4)
    rows = [(float(a), float(b), float(a > 0.4) * 10 + float(rng.normal()) * 0.1) for a, b in rng.random((n, 2))]
    df = spark.createDataFrame(rows, "a double, b double, label double").repartition(parts)
    return fe.assemble(df, ["a", "b"])


def test_drawn_splits_against_the_rows(spark):
    ready = _points(spark).cache()
    model = et.extra_trees(ready, trees=3, depth=3, seed=9)
    data = np.array([[r.a, r.b, r.label] for r in ready.collect()])
    for t in range(3):
        inside = {0: np.ones(len(data), dtype=bool)}
        for at in range(7):
            if at not in inside or model.trees.feature[t, at] < 0:
                continue
            f, cut = model.trees.feature[t, at], model.trees.threshold[t, at]
            here = data[inside[at]]
            assert here[:, f].min() <= cut < here[:, f].max()
            below = data[:, f] <= cut
            for child, side in ((2 * at + 1, below), (2 * at + 2, ~below)):
                inside[child] = inside[at] & side
                assert model.trees.value[t, child] == pytest.approx(data[inside[child], 2].mean(), rel=1e-9)
    x = data[:, :2]
    want = np.mean([model.trees.value[t, model.trees.place(x, t, 3)] for t in range(3)], axis=0)
    got = {(r.a, r.b): r.prediction for r in model.transform(ready).collect()}
    assert [got[a, b] for a, b in x] == pytest.approx(list(want))


def test_extra_trees_do_not_depend_on_the_layout(spark):
    one, two = (et.extra_trees(_points(spark, parts=p), trees=2, depth=4, seed=1) for p in (1, 5))
    assert (one.trees.feature == two.trees.feature).all() and one.trees.threshold == pytest.approx(two.trees.threshold)
    other = et.extra_trees(_points(spark), trees=2, depth=4, seed=2)
    assert one.trees.threshold[0, 0] != other.trees.threshold[0, 0]
    deep = et.extra_trees(_points(spark), trees=30, depth=6, seed=1)
    error = deep.transform(_points(spark)).agg(F.avg(F.pow(F.col("prediction") - F.col("label"), 2))).first()[0]
    assert error < 1.0


def test_extra_trees_of_odd_tables(spark):
    flat = fe.assemble(spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "a double, label double"), ["a"])
    model = et.extra_trees(flat, trees=2, depth=3)
    assert [r.prediction for r in model.transform(flat).collect()] == [3.0, 3.0]
    assert [(r.node, r.feature) for r in et.splits(spark, model, ["a"]).where("tree = 0").collect()] == [(0, None)]
    with pytest.raises(ValueError):
        et.extra_trees(flat.limit(0))
    gap = flat.union(spark.createDataFrame([(None, None, None)], flat.schema))
    assert {r.prediction for r in model.transform(gap).collect()} == {3.0, None}


def test_inflation_of_a_factor_by_hand(spark):
    rng = np.random.default_rng(1)
    level = rng.integers(0, 3, 90)
    x = level + rng.normal(size=90)
    w = rng.random(90) + 0.1
    rows = [(float(v), int(k == 1), int(k == 2), float(u)) for v, k, u in zip(x, level, w)]
    df = spark.createDataFrame(rows + [(None, 1, 0, 1.0)], "x double, f1 int, f2 int, w double")
    terms = {"f": ["f1", "f2"], "x": ["x"]}

    def by_hand(w):
        square = lambda v, u: float(np.sum(u * (v - np.average(v, weights=u)) ** 2))
        return square(x, w) / sum(square(x[level == k], w[level == k]) for k in range(3))

    for weight, want in ((None, by_hand(np.ones(90))), (F.col("w"), by_hand(w))):
        got = {r.term: r for r in st.generalised_inflation(df, terms, weight).collect()}
        assert got["f"].gvif == pytest.approx(want) and got["x"].gvif == pytest.approx(want)
        assert (got["f"].df, got["x"].df) == (2, 1) and got["f"].gvif_scaled == pytest.approx(want**0.25)
    plain = {r.predictor: r.vif for r in st.variance_inflation(df.dropna(), ["x", "f1", "f2"]).collect()}
    single = {r.term: r.gvif for r in st.generalised_inflation(df, {c: [c] for c in plain}).collect()}
    assert single == pytest.approx(plain)
    twice = st.generalised_inflation(df.withColumn("y", 2 * F.col("x")), {"x": ["x"], "y": ["y"], "f1": ["f1"]}).collect()
    assert [r.gvif for r in twice][:2] == [None, None]
    assert st.generalised_inflation(df.limit(0), terms).count() == 0


def test_two_planted_breaks_remain_of_twenty(spark):
    n, knots = 501, 20
    days = np.arange(n)
    y = 5 + 0.02 * days + 0.3 * np.maximum(days - 100, 0) - 0.5 * np.maximum(days - 300, 0)
    y = y + np.random.default_rng(3).normal(size=n) * 0.05
    rows = [("a", START + dt.timedelta(days=int(d)), float(v)) for d, v in zip(days, y)]
    df = spark.createDataFrame(rows, "k string, ds date, y double")
    shape = tr.Shape(changepoints=knots, changepoint_range=0.8, yearly=0, weekly=0, changepoint_scale=0.05, sparse=True)
    found = tr.changes(tr.fit(df, shape, ["k"]), shape, ["k"]).orderBy("knot").collect()
    big = {(r.ds - START).days: r.change for r in found if r.change != 0}
    assert set(big) == {100, 300} and big[100] == pytest.approx(0.3, rel=0.05) and big[300] == pytest.approx(-0.5, rel=0.05)
    dense = tr.replace(shape, sparse=False)
    assert all(r.change != 0 for r in tr.changes(tr.fit(df, dense, ["k"]), dense, ["k"]).collect())
    grid = [(0.05, 1.0), (0.5, 1.0)]
    scores = tr.rolling_origin(df, shape, grid, 30, 350, 40, ["k"]).collect()
    assert len(scores) == 2 and all(r.rmse < 5 for r in scores)


def test_extra_trees_scan_blocks_instead_of_rows(spark, monkeypatch):
    """The rows are packed once; every scan of a level reads blocks and hands on one row per node, whatever the number of rows."""
    handed = []
    packed = et._packed

    def watched(table):
        out = packed(table)
        handed.append(out)
        return out

    monkeypatch.setattr(et, "_packed", watched)
    ready = _points(spark, n=3000, parts=2)
    model = et.extra_trees(ready, trees=2, depth=3, seed=9)
    blocks = handed[0]
    assert blocks.count() <= 4 and blocks.agg(F.sum("n")).first()[0] == 3000
    # Handing on after every tree gives the same trees.
    monkeypatch.setattr(et, "HELD", 1)
    again = et.extra_trees(ready, trees=2, depth=3, seed=9)
    assert (model.trees.feature == again.trees.feature).all() and (model.trees.threshold == again.trees.threshold).all()
    assert again.trees.value == pytest.approx(model.trees.value, rel=1e-9)


def test_extra_trees_score_batches_with_gaps(spark):
    """Scoring reads whole Arrow arrays; rows without features keep their place."""
    ready = _points(spark, n=50, parts=1)
    model = et.extra_trees(ready, trees=2, depth=3, seed=9)
    gaps = ready.withColumn("features", F.when(F.col("a") < 0.5, F.col("features"))).select("a", "b", "features")
    got = {(r.a, r.b): r.prediction for r in model.transform(gaps).collect()}
    for a, b in got:
        x = np.array([[a, b]])
        want = np.mean([model.trees.value[t, model.trees.place(x, t, 3)] for t in range(2)])
        assert got[a, b] == (pytest.approx(want) if a < 0.5 else None)


def test_shuffled_features_use_more_tasks_for_more_rows(spark, monkeypatch):
    """The tasks that put values in their places hold a bounded number of them."""
    monkeypatch.setattr(cl, "CELLS", 10)
    placed = spark.range(60).select((F.col("id") + 1).alias("_place"), F.col("id").alias("v"))
    moved = cl.shuffled_features(placed, ["v", "v"], 60, seed=1)
    assert moved.rdd.getNumPartitions() == 12
    rows = moved.collect()
    assert sorted(r._place for r in rows) == list(range(1, 61))
    for i in range(2):
        assert sorted(r._moved[i] for r in rows) == list(range(60))


def test_reweighting_predicts_once_a_round_and_keeps_its_trees(spark, monkeypatch):
    """A cached table is not written again, and every round but the last writes one table."""
    written = []
    monkeypatch.setattr(rg, "checkpointed", lambda df: written.append(df.columns) or df.localCheckpoint())
    ready = _points(spark).select("features", "label")
    plain = rg.boost_by_reweighting(ready, rounds=3, depth=2)
    assert len(written) == 3
    written.clear()
    cached = rg.boost_by_reweighting(ready.persist(), rounds=3, depth=2)
    assert len(written) == 2
    assert cached.votes == pytest.approx(plain.votes) and [t.toDebugString.split("\n")[1:] for t in cached.trees] == [t.toDebugString.split("\n")[1:] for t in plain.trees]
