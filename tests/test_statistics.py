"""Tests, fit measures and distributions against known values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.functions import distributions as ds
from larkspur.functions.linalg import grouped_ols
from larkspur.operators import stats


def test_student_t_table_values():
    assert ds.t_critical(0.95, 10) == pytest.approx(2.228139, abs=1e-5)
    assert ds.t_critical(0.95, 1e6) == pytest.approx(1.959966, abs=1e-5)
    assert ds.t_two_sided(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    # A published test result: t = 0.080057 with 5872.3 degrees of freedom.
    assert ds.t_two_sided(0.080057, 5872.3) == pytest.approx(0.9362, abs=1e-4)


def test_normal_share(spark):
    df = spark.createDataFrame([(-1.0,), (1.0,)], "x double")
    row = stats.share_below(df, "x", math.sqrt(2) * 1.959963984540054).first()
    assert row.share == pytest.approx(0.975, abs=1e-9)


def test_welch(spark):
    a, b = [30.02, 29.99, 30.11, 29.97, 30.01, 29.99], [29.89, 29.93, 29.72, 29.98, 30.02, 29.98]
    df = spark.createDataFrame([("a", v) for v in a] + [("b", v) for v in b], "g string, x double")
    row = stats.welch_test(df, "g", "x", "a", "b").first()
    assert (row.t, row.df, row.p_value) == (pytest.approx(1.959, abs=1e-3), pytest.approx(7.03, abs=1e-2), pytest.approx(0.0907, abs=1e-3))
    assert row.ci_low < 0 < row.ci_high


def test_class_report_by_hand(spark):
    data = [(1, 1)] * 6 + [(1, 0)] * 2 + [(0, 0)] * 9 + [(0, 1)] * 3
    got = {r["class"]: r for r in stats.class_report(spark.createDataFrame(data, "p int, a int"), "p", "a", [0, 1, 2]).collect()}
    assert got[1].precision == pytest.approx(6 / 8) and got[1].recall == pytest.approx(6 / 9)
    assert got[0].accuracy == pytest.approx(15 / 20)
    assert got[2].precision is None and got[2].f_score is None


def test_error_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.5), (4.0, None)], "y double, p double")
    row = stats.error_metrics(df, "y", "p").first()
    assert (row.mse, row.r2) == (pytest.approx(0.5 / 3), pytest.approx(0.75))


def test_inflation(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    x[:, 2] = x[:, 0] + 0.3 * rng.normal(size=300)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    want = np.diag(np.linalg.inv(np.corrcoef(x.T)))
    assert [r.vif for r in stats.variance_inflation(df, ["a", "b", "c"]).collect()] == pytest.approx(list(want))


def test_least_squares_against_numpy(spark):
    rng = np.random.default_rng(2)
    data, want = [], {}
    for key in ("a", "b"):
        x = rng.normal(size=(80, 2)) * [1, 1000]
        y = 5 + x @ [2, -0.01] + rng.normal(size=80)
        design = np.column_stack([np.ones(80), x])
        coef, sse, *_ = np.linalg.lstsq(design, y, rcond=None)
        cov = sse[0] / 77 * np.linalg.inv(design.T @ design)
        want[key] = (coef, np.sqrt(np.diag(cov)), sse[0])
        data += [(key, float(a), float(b), float(c)) for (a, b), c in zip(x, y)]
    data.append(("a", None, 1.0, 1.0))
    df = spark.createDataFrame(data, "k string, a double, b double, y double").repartition(6)
    for row in grouped_ols(df, "y", ["a", "b"], ["k"]).collect():
        coef, stderr, sse = want[row.k]
        assert row.coef == pytest.approx(list(coef), rel=1e-8) and row.stderr == pytest.approx(list(stderr), rel=1e-6)
        assert row.sse == pytest.approx(sse, rel=1e-8) and row.n == 80


def test_collinear_columns_do_not_break_the_fit(spark):
    df = spark.range(20).select(F.col("id").cast("double").alias("a"), (2.0 * F.col("id")).alias("b"), (3.0 * F.col("id") + 1).alias("y"))
    row = grouped_ols(df, "y", ["a", "b"]).first()
    assert row["rank"] == 2 and row.sse == pytest.approx(0.0, abs=1e-6)


def test_distribution_columns_against_exact_values(spark):
    rows = [(float(x),) for x in (-38, -8.5, -3.6, -3.5, -1.96, -0.3, 0, 1e-9, 0.7, 2.4, 3.54, 6)] + [(None,), (float("nan"),)]
    got = spark.createDataFrame(rows, "x double").select("x", ds.normal_cdf("x").alias("p")).collect()
    for r in got:
        if r.x is None or math.isnan(r.x):
            assert r.p is None
        else:
            assert r.p == pytest.approx(0.5 * math.erfc(-r.x / math.sqrt(2)), rel=1e-11, abs=1e-300)
    cases = [(t, df) for t in (0.0, -0.01, 0.5, 1.0, 1.7, -1.8, 3.0, 10.0, 100.0) for df in (1.0, 2.0, 5.5, 30.0, 1000.0, 6e5, 1e9)]
    got = spark.createDataFrame(cases + [(1.0, 0.0), (None, 3.0), (2.0, None)], "t double, df double").select("t", "df", ds.t_p_value("t", "df").alias("p")).collect()
    for r in got[:-3]:
        if r.df == 1e9:  # log gamma cancels in the number form; the normal tail is as near as 1e-7 here
            assert r.p == pytest.approx(math.erfc(abs(r.t) / math.sqrt(2)), rel=1e-5, abs=1e-300), r
        else:
            assert r.p == pytest.approx(ds.t_two_sided(r.t, r.df), rel=1e-10 if r.df < 1e5 else 1e-8, abs=1e-14), r
    assert [r.p for r in got[-3:]] == [None] * 3
    got = spark.createDataFrame([(d,) for d in (1.0, 2.0, 10.0, 500.0, 1e6)] + [(0.0,), (None,)], "df double")
    for level in (0.9, 0.95, 0.99):
        found = got.select("df", ds.t_quantile(level, "df").alias("q")).collect()
        # The number form cancels digits of log gamma for many degrees of freedom; the columns do not.
        assert all(r.q == pytest.approx(ds.t_critical(level, r.df), rel=1e-10 if r.df < 1e4 else 1e-8) for r in found[:-2])
        assert [r.q for r in found[-2:]] == [None, None]
    # Exact: with one degree of freedom the distribution is Cauchy's, with two it is algebraic.
    one = spark.createDataFrame([(3.0,)], "t double").select(ds.t_p_value("t", F.lit(1.0)).alias("a"), ds.t_p_value("t", F.lit(2.0)).alias("b")).first()
    assert one.a == pytest.approx(1 - 2 * math.atan(3) / math.pi, rel=1e-12) and one.b == pytest.approx(1 - 3 / math.sqrt(11), rel=1e-12)
