"""Constant columns, one flat key among several, nulls only, empty tables, negative zeros and large means."""

import pytest
from pyspark.sql import functions as F

from larkspur.functions.linalg import grouped_ols
from larkspur.operators import aggregates as ag
from larkspur.operators import chartdata as cd
from larkspur.operators import profile as pr
from larkspur.operators import quantiles, ranking
from larkspur.operators import sampling as sa
from larkspur.operators import stats as st
from larkspur.series import diagnostics as di
from larkspur.series import prep, trend
from larkspur.sources import delimited


@pytest.fixture(scope="module")
def flat(spark):
    rows = [(i, 5.0, float(i % 7), None, "a" if i % 2 else "b") for i in range(60)]
    return spark.createDataFrame(rows, "i long, flat double, x double, none double, g string")


def test_correlations_are_null_without_spread(flat):
    assert ag.pearson(flat, "flat", "x").first()[0] is None
    assert ag.pearson(flat, "none", "x").first()[0] is None
    assert ag.pearson(flat.limit(0), "x", "i").first()[0] is None
    assert ag.pearson(flat, "x", "x").first()[0] == pytest.approx(1)
    wide = flat.select("flat", "x", "i", *[(F.col("i") * (k + 1) % 11).cast("double").alias(f"c{k}") for k in range(12)])
    for frame in (wide.select("flat", "x", "i"), wide):
        cells = {(r.var1, r.var2): r["corr"] for r in ag.correlation_matrix(frame).collect()}
        assert cells["flat", "x"] is None and cells["x", "i"] is not None
        assert all("flat" not in (r.var1, r.var2) for r in ag.strongest_pairs(ag.correlation_matrix(frame), 3).collect())


def test_both_matrix_paths_agree(flat):
    frame = flat.select("x", "i", *[(F.col("i") * (k + 2) % 13).cast("double").alias(f"c{k}") for k in range(12)])
    wide = {(r.var1, r.var2): r["corr"] for r in ag.correlation_matrix(frame).collect()}
    small = {(r.var1, r.var2): r["corr"] for r in ag.correlation_matrix(frame.select("x", "i", "c1", "c5")).collect()}
    assert all(wide[k] == pytest.approx(v) for k, v in small.items())


def test_tests_and_shares_are_null_without_spread(flat):
    assert st.share_below(flat, "flat", 3.0).first().z is None
    row = st.welch_test(flat, "g", "flat", "a", "b").first()
    assert row.t is None and row.p_value is None and row.mean_first == 5.0
    assert st.welch_test(flat.limit(0), "g", "x", "a", "b").first().t is None


def test_density_of_a_constant(flat):
    rows = cd.density(flat, "flat", 5).collect()
    assert len(rows) == 5 and all(r.density is None for r in rows)
    total = sum(r.density for r in cd.density(flat, "x", 200).collect()) * (2 * 6.0 / 199)
    assert total == pytest.approx(1, abs=0.02)


def test_series_without_spread_or_length(spark):
    import datetime as dt

    day = dt.date(2020, 1, 1)
    rows = [("flat", day + dt.timedelta(i), 4.0) for i in range(190)] + [("short", day + dt.timedelta(i), float(i % 3)) for i in range(10)]
    rows += [("long", day + dt.timedelta(i), float((i * 7919) % 101)) for i in range(190)]
    df = spark.createDataFrame(rows, "k string, ds date, y double")
    assert {r.k for r in di.autocorrelation(df, 3, by=["k"]).where("acf IS NOT NULL").collect()} == {"short", "long"}
    zero = df.withColumn("resid", F.when(F.col("k") == "flat", 0.0).otherwise(F.col("y")))
    watson = {r.k: r.durbin_watson for r in di.durbin_watson(zero, by=["k"]).collect()}
    assert watson["flat"] is None and watson["long"] > 0
    assert len(di.residual_checks(zero, by=["k"]).collect()) == 3
    tested = {r.k: r for r in di.unit_root_test(df.where("k <> 'flat'"), by=["k"]).collect()}
    assert tested["short"].statistic is None and tested["short"].n_obs == 10 and tested["long"].statistic < 0
    pair = prep.paired_correlation(df.where("k = 'flat'").withColumn("z", F.dayofmonth("ds").cast("double")), "y", "z").first()
    assert pair.levels is None


def test_one_zero(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.0,), (None,)], "v double")
    assert pr.distinct_counts(df).first()["distinct"] == 2


@pytest.mark.parametrize("offset", [0.0, 1e8])
def test_least_squares_with_a_large_mean(spark, offset):
    df = spark.range(20_000).select(((F.col("id") * 7919) % 1000 / 10.0 + offset).alias("x"), ((F.xxhash64("id") % 1000) / 500.0).alias("e"))
    df = df.withColumn("y", 2 * F.col("x") + F.col("e"))
    row = grouped_ols(df, "y", ["x"]).first()
    want = df.agg(F.regr_slope("y", "x").alias("slope"), F.regr_r2("y", "x").alias("r2")).first()
    assert row.coef[1] == pytest.approx(want.slope, rel=1e-6) and row.r2 == pytest.approx(want.r2, rel=1e-6) and row.stderr[1] > 0


def test_saturating_fit_keeps_extreme_values(spark):
    import datetime as dt
    import math

    rows = []
    for i in range(300):
        y = 100 / (1 + math.exp(-(i - 150) / 20))
        rows.append((dt.date(2020, 1, 1) + dt.timedelta(i), 0.0 if i < 5 else 120.0 if i == 290 else y))
    df = spark.createDataFrame(rows, "ds date, y double")
    shape = trend.Shape(capacity=100.0, yearly=0, weekly=0, changepoints=5)
    predicted = trend.predict(df.select("ds"), trend.fit(df, shape), shape)
    errors = {r.ds: r for r in trend.residuals(df, predicted).collect()}
    middle = [abs(errors[d].resid) for d, _ in rows[100:200]]
    assert max(middle) < 3 and errors[rows[290][0]].y == 120.0


def test_preamble_is_named_and_other_rows_stay(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("Category: all\n\nWeek,amount\n2020-01-05,3\n05.01.2020,4\nbroken,5\n2020-01-12,x\n")
    rows = delimited.read_after_preamble(spark, str(path), "week", ["amount"], preamble=["Category: all", "Week"]).collect()
    assert sorted((str(r.week), r.amount) for r in rows) == [("2020-01-05", 3.0), ("2020-01-12", None), ("None", 4.0), ("None", 5.0)]


def test_sizes_change_the_plan_but_not_the_answer(spark, monkeypatch):
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 1009).cast("double").alias("v"))
    def answers():
        q = [tuple(r) for r in quantiles.quantile_table(df, "v", {"a": 0.25, "b": 0.7}, ["g"]).orderBy("g").collect()]
        n = [tuple(r) for r in ranking.number_rows(df, ["id"], ["g"]).orderBy("id").collect()]
        s = sorted(r.id for r in sa.sample_per_class(df, "g", 50, ["id"]).collect())
        return q, n, s
    broadcast = answers()
    monkeypatch.setattr(ranking, "small_side", lambda d, rows=0: d)
    monkeypatch.setattr(quantiles, "small_side", lambda d, rows=0: d)
    monkeypatch.setattr(sa, "small_side", lambda d, rows=0: d)
    assert answers() == broadcast
    monkeypatch.setattr(quantiles, "SMALL_GROUP_ROWS", 10)
    monkeypatch.setattr(quantiles, "SINGLE_TASK_ROWS", 1)
    assert answers()[0] == broadcast[0]


def test_no_shuffle_of_the_table_on_few_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1024")
    try:
        df = spark.range(20_000).select("id", (F.col("id") % 3).alias("g"), (F.col("id") % 97).cast("double").alias("v"))
        plan = sa.split_stratified(df, "g", 0.5, ["id"])._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_flat_series_keep_their_rows(spark):
    from datetime import date, timedelta

    from larkspur.series import diagnostics as dg

    rows = [(k, date(2020, 1, 1) + timedelta(i), 4.0 if k == "flat" else float((i * 7) % 5)) for k in ("flat", "moves") for i in range(12)]
    df = spark.createDataFrame(rows, "k string, ds date, y double")
    for table, name in ((dg.autocorrelation(df, 3, by=["k"]), "acf"), (dg.partial_autocorrelation(df, 3, by=["k"]), "pacf")):
        got = {(r.k, r.lag): r[name] for r in table.collect()}
        assert len(got) == 8 and all(got["flat", lag] is None for lag in range(4)) and all(got["moves", lag] is not None for lag in range(4))
    tests = {r.k: r for r in dg.unit_root_test(df, by=["k"], lag=1).collect()}
    assert tests["flat"].statistic is None and tests["flat"].n_obs == 12 and tests["moves"].statistic is not None


def test_binned_density_within_its_bound(spark):
    import math

    df = spark.range(4000).select(((F.xxhash64("id") % 1000) / 100.0 + F.when(F.col("id") % 97 == 0, 60.0).otherwise(0.0)).alias("x"))
    exact = {r.k: r for r in cd.density(df, "x", 40).collect()}
    h = df.agg(F.stddev_samp("x")).first()[0] * 4000 ** -0.2
    for steps in (4, 50):
        near = cd.binned_density(df, "x", 40, steps).collect()
        assert len(near) == 40
        assert max(abs(r.density - exact[r.k].density) for r in near) <= 1 / (8 * steps**2) / (h * math.sqrt(2 * math.pi)) + 1e-12
    flat = df.withColumn("x", F.lit(2.0))
    assert [r.density for r in cd.binned_density(flat, "x", 3).collect()] == [None] * 3
    assert cd.binned_density(df.limit(0), "x", 3).collect() == []
