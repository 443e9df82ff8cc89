"""Cross products in blocks, and what is fitted from them."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from larkspur.functions import gram
from larkspur.models import features as fe
from larkspur.models import penalised as pn
from larkspur.models import regression as rg
from larkspur.operators import aggregates as ag


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(240, 7)) * [1, 5, 0.1, 1000, 1, 2, 1] + [0, 3, 1e4, -7, 0, 0, 2]
    x[:, 5] = x[:, 0] + 0.1 * x[:, 4]
    y = 3 * x[:, 0] - 0.5 * x[:, 1] + 0.002 * x[:, 3] + rng.normal(size=240)
    rows = [(int(i), int(i % 4), *map(float, x[i]), float(y[i])) for i in range(240)]
    names = [f"x{k}" for k in range(7)]
    frame = spark.createDataFrame(rows, "id long, g int, " + ", ".join(f"{n} double" for n in names) + ", y double").repartition(5)
    return frame, names, x, y


@pytest.mark.parametrize("block", [1, 3, 256])
def test_blocks_add_up(table, block):
    frame, names, x, y = table
    odd = frame.withColumn("g", F.when(F.col("g") > 0, F.col("g"))).withColumn("x1", F.when(F.col("id") % 10 != 3, F.col("x1")))
    found = gram.gather(gram.cross_products(odd, [*names, "y"], ["g"], block), ["g"])
    whole = np.column_stack([x, y])
    keep = np.arange(240) % 10 != 3
    assert set(found) == {(None,), (1,), (2,), (3,)}
    for (g,), p in found.items():
        rows = whole[keep & (np.arange(240) % 4 == (g or 0))]
        apart = rows - rows.mean(0)
        assert p.n == len(rows) and p.mean == pytest.approx(rows.mean(0)) and p.gram == pytest.approx(apart.T @ apart, rel=1e-9, abs=1e-7)
    total = sum((found[(g,)] for g in (1, 2, 3)), found[(None,)])
    rest, rows = total - found[(2,)], whole[keep & (np.arange(240) % 4 != 2)]
    assert rest.n == len(rows) and rest.gram == pytest.approx((rows - rows.mean(0)).T @ (rows - rows.mean(0)), rel=1e-8, abs=1e-6)
    arrays = gram.gather(gram.cross_products(frame.select(F.array(*names, "y").alias("v")), "v", (), block))[()]
    assert arrays.raw() == pytest.approx(whole.T @ whole, rel=1e-9)
    assert gram.gather(gram.cross_products(frame.limit(0), names)) == {}


@pytest.mark.parametrize("mixing", [1.0, 0.4])
def test_path_is_the_same_as_sparks(table, mixing):
    frame, names, x, y = table
    few = [n for n in names if n not in ("x2", "x5")]  # columns on which the iterations of the other side do not settle
    ready = VectorAssembler(inputCols=few, outputCol="features").transform(frame).withColumnRenamed("y", "label")
    for penalty in (0.01, 0.3, 1.5):
        theirs = LinearRegression(elasticNetParam=mixing, regParam=penalty, tol=1e-11, maxIter=5000).fit(ready)
        mine = pn.elastic_net_fit(frame, "y", few, penalty, mixing)
        assert mine.coefficients == pytest.approx(list(theirs.coefficients), abs=1e-6) and mine.intercept == pytest.approx(theirs.intercept, abs=1e-5)
        # With all columns: no slope of the objective is left, and none beyond the penalty where a coefficient is zero.
        fit = pn.elastic_net_fit(frame, "y", names, penalty, mixing)
        w, unit = np.array(fit.coefficients), x.std(axis=0)
        off = y - x @ w - fit.intercept
        pull = (x - x.mean(axis=0)).T @ off / 240 / unit - penalty * (1 - mixing) / y.std() * w * unit
        assert abs(off.mean()) < 1e-9
        assert np.where(w != 0, np.abs(pull - penalty * mixing * np.sign(w)), np.maximum(np.abs(pull) - penalty * mixing, 0)) == pytest.approx(np.zeros(7), abs=1e-9)


def test_lasso_by_folds_against_single_fits(table):
    frame, names, x, y = table
    fit = pn.lasso_by_folds(frame, "y", names, F.col("g"), count=100)
    errors = {(r.fold, r.penalty): r.mse for r in fit.errors.collect()}
    assert len(errors) == 400
    penalties = sorted({p for _, p in errors})
    for fold in (0, 3):
        known = frame.where(F.col("g") != fold)
        for penalty in (penalties[5], penalties[60]):
            one = pn.elastic_net_fit(known, "y", names, penalty, 1.0)
            held = np.arange(240) % 4 == fold
            off = y[held] - x[held] @ np.array(one.coefficients) - one.intercept
            assert errors[fold, penalty] == pytest.approx((off * off).mean(), rel=1e-6)
    mean = {p: sum(errors[f, p] for f in range(4)) / 4 for p in penalties}
    assert fit.penalty == max(p for p in penalties if mean[p] <= min(mean.values()))
    assert fit.coefficients == pytest.approx(pn.elastic_net_fit(frame, "y", names, fit.penalty, 1.0).coefficients, abs=1e-7)
    said = frame.select("y", fit.score().alias("p")).collect()
    assert np.mean([(r.y - r.p) ** 2 for r in said]) < 1.5
    empty = pn.lasso_by_folds(frame.limit(0), "y", names, F.col("g"))
    assert empty.coefficients == [0.0] * 7 and empty.errors is None


def test_wide_least_squares_is_the_same_on_few_columns(table):
    frame, names, _, _ = table
    narrow = {r.term: r for r in rg.ols_table(frame, "y", names).collect()}
    for r in rg.wide_ols(frame, "y", names).collect():
        for c in ("estimate", "stderr", "t", "p_value", "r2"):
            assert r[c] == pytest.approx(narrow[r.term][c], rel=1e-6, abs=1e-9)
    assert rg.wide_ols(frame.limit(0), "y", names).collect() == []


def test_fifteen_hundred_columns(spark):
    width, count = 1500, 400
    names = [f"c{k}" for k in range(width)]
    cell = lambda k: ((F.xxhash64("id", F.lit(k)) % 1000) / 500.0 + (F.col("id") % 7 if k % 3 == 0 else F.lit(0))).cast("double")
    wide = spark.range(count).select("id", *[cell(k).alias(n) for k, n in enumerate(names[:-1])], F.lit(0.1).alias(names[-1]))
    wide = wide.checkpoint()
    data = np.array([tuple(r)[1:] for r in wide.collect()])
    cells = ag.correlation_matrix(wide, names).where("i IN (0, 700, 1499) AND j IN (3, 299, 1498, 1499)").collect()
    assert len(cells) == 12
    with np.errstate(invalid="ignore"):
        for r in cells:
            if width - 1 in (r.i, r.j):
                assert r["corr"] is None
            else:
                assert r["corr"] == pytest.approx(np.corrcoef(data[:, r.i], data[:, r.j])[0, 1], abs=1e-9) and r.var1 == names[r.i]
    reduced = fe.truncated_svd(wide, names, 2).select("svd_1", "svd_2").collect()
    scores = np.array([tuple(r) for r in reduced])
    u, s, _ = np.linalg.svd(data, full_matrices=False)
    assert np.abs(scores) == pytest.approx(np.abs(u[:, :2] * s[:2]), rel=1e-6, abs=1e-6)
    fit = pn.elastic_net_fit(wide.withColumn("t", F.col("c3") * 2 - F.col("c5")), "t", names, 0.02, 1.0)
    weights = dict(zip(names, fit.coefficients))
    assert weights["c3"] > 1.9 and weights["c5"] < -0.9 and sum(w != 0 for w in weights.values()) < 50
