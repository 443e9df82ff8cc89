"""Series operators against direct numpy calculations."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.series import arima as ar
from larkspur.series import diagnostics as dg
from larkspur.series import prep as sp
from larkspur.series import trend as tr

START = dt.date(2015, 1, 4)


def table(spark, series, step=7):
    rows = [(k, START + dt.timedelta(days=step * i), float(v)) for k, ys in series.items() for i, v in enumerate(ys)]
    return spark.createDataFrame(rows, "k string, ds date, y double").repartition(4)


@pytest.fixture(scope="module")
def noise():
    rng = np.random.default_rng(4)
    walk = np.cumsum(rng.normal(size=300))
    ar1 = np.zeros(400)
    for i in range(1, 400):
        ar1[i] = 0.6 * ar1[i - 1] + rng.normal()
    return {"walk": walk, "ar1": ar1[100:]}


def acf(y, lags):
    e = y - y.mean()
    return [float(e[k:] @ e[:len(e) - k] / (e @ e)) for k in range(lags + 1)]


def test_autocorrelations(spark, noise):
    df = table(spark, noise)
    got = {(r.k, r.lag): r.acf for r in dg.autocorrelation(df, 12, by=["k"]).collect()}
    pacf = {(r.k, r.lag): r.pacf for r in dg.partial_autocorrelation(df, 12, by=["k"]).collect()}
    for key, y in noise.items():
        r = acf(y, 12)
        assert [got[(key, k)] for k in range(13)] == pytest.approx(r)
        for k in range(1, 13):  # Yule-Walker: the last weight of the k-th system
            system = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
            assert pacf[(key, k)] == pytest.approx(np.linalg.solve(system, r[1:k + 1])[-1], abs=1e-8)


def adf(y, lag):
    d = np.diff(y)
    rows = np.array([[1.0, y[i], *[d[i - j] for j in range(1, lag + 1)]] for i in range(lag, len(d))])
    target = d[lag:]
    coef, *_ = np.linalg.lstsq(rows, target, rcond=None)
    sse = float(((target - rows @ coef) ** 2).sum())
    var = sse / (len(target) - rows.shape[1]) * np.linalg.inv(rows.T @ rows)
    return coef[1] / np.sqrt(var[1, 1]), sse, rows.shape


def test_unit_root(spark, noise):
    df = table(spark, noise)
    got = {r.k: r for r in dg.unit_root_test(df, by=["k"], max_lag=4).collect()}
    for key, y in noise.items():
        row = got[key]
        assert row.statistic == pytest.approx(adf(y, row.lags)[0], rel=1e-6)
        assert row.n_obs == len(y) - 1 - row.lags
    assert got["walk"].p_value > 0.05 > got["ar1"].p_value
    assert got["ar1"].critical_1 < got["ar1"].critical_5 < got["ar1"].critical_10 < 0
    assert dg.unit_root_p(-2.86) == pytest.approx(0.05, abs=0.002)


def test_durbin_watson_and_checks(spark):
    e = [1.0, -1.0, 2.0, 0.5]
    df = table(spark, {"a": e}).withColumnRenamed("y", "resid")
    want = (4 + 9 + 2.25) / (1 + 1 + 4 + 0.25)
    assert dg.durbin_watson(df).first()[0] == pytest.approx(want)
    assert dg.residual_checks(df, by=["k"]).first().durbin_watson == pytest.approx(want)


def test_autoregression_recovers_its_weight(spark, noise):
    model = ar.fit(table(spark, {"ar1": noise["ar1"]}), ar.Order(p=1), ["k"])
    rows = {r.term: r for r in model.interval_table().collect()}
    assert rows["ar_1"].low < 0.6 < rows["ar_1"].high
    y = noise["ar1"]
    design = np.column_stack([np.ones(len(y) - 1), y[:-1]])
    coef, *_ = np.linalg.lstsq(design, y[1:], rcond=None)
    assert [rows["(constant)"].estimate, rows["ar_1"].estimate] == pytest.approx(list(coef))
    first = [r.yhat for r in ar.forecast(model, 2, 7).orderBy("ds").collect()]
    one = coef[0] + coef[1] * y[-1]
    assert first == pytest.approx([one, coef[0] + coef[1] * one])


def test_moving_average_recovers_its_weight(spark):
    rng = np.random.default_rng(8)
    e = rng.normal(size=1500)
    y = e[1:] + 0.5 * e[:-1]
    model = ar.fit(table(spark, {"ma": y}, step=1), ar.Order(q=1), ["k"])
    assert {r.term: r.estimate for r in model.interval_table().collect()}["ma_1"] == pytest.approx(0.5, abs=0.1)


def test_differenced_forecast_integrates_back(spark):
    line = {"a": [3.0 + 2.0 * i for i in range(60)], "b": [5.0 - i for i in range(60)]}
    got = ar.forecast(ar.fit(table(spark, line), ar.Order(1, 1, 0), ["k"]), 3, 7).orderBy("k", "ds").collect()
    assert [r.yhat for r in got] == pytest.approx([123, 125, 127, -55, -56, -57], abs=1e-6)
    assert got[0].ds == START + dt.timedelta(days=7 * 60)


def test_seasonal_walk(spark):
    rng = np.random.default_rng(1)
    y = list(rng.normal(size=30))
    df = table(spark, {"a": y})
    out = ar.seasonal_walk(df, 4, ["k"]).orderBy("ds").collect()
    assert out[9].fitted == pytest.approx(y[8] + y[5] - y[4]) and out[4].fitted is None
    path = list(y)
    for _ in range(6):
        path.append(path[-1] + path[-4] - path[-5])
    got = [r.yhat for r in ar.seasonal_walk_forecast(df, 4, 6, 7, ["k"]).orderBy("ds").collect()]
    assert got == pytest.approx(path[30:])
    same = ar.fit(df, ar.Order(d=1, seasonal_d=1, season=4), ["k"]).history.where("ds > '2015-03-01'").orderBy("ds").collect()
    assert [r.fitted for r in same] == pytest.approx([r.fitted for r in out if r.ds > dt.date(2015, 3, 1)])


def test_outside_regressor(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=200) * 10
    y = np.cumsum(rng.normal(size=200) * 0.1) + 2.5 * x
    df = table(spark, {"a": y}).join(table(spark, {"a": x}).withColumnRenamed("y", "x"), ["k", "ds"])
    model = ar.fit(df, ar.Order(1, 1, 0), ["k"], exog=["x"])
    assert {r.term: r.estimate for r in model.interval_table().collect()}["x_effect"] == pytest.approx(2.5, abs=0.02)
    future = table(spark, {"a": [0.0] * 200 + [1.0, 2.0]}).where(F.col("ds") >= START + dt.timedelta(days=1400)).withColumnRenamed("y", "x")
    ahead = [r.yhat for r in ar.forecast(model, 2, 7, future).orderBy("ds").collect()]
    assert ahead[1] - ahead[0] == pytest.approx(2.5, abs=0.3)


def test_grid_matches_single_fits_and_prefers_the_truth(spark, noise):
    df = table(spark, {"ar1": noise["ar1"]})
    orders = [ar.Order(p=p) for p in (0, 1, 2)] + [ar.Order(p=1, d=1)]
    grid = {r.params: r for r in ar.grid_aic(df, orders, ["k"]).collect()}
    y = noise["ar1"]
    start = max(o.start for o in orders)
    design = np.column_stack([np.ones(len(y) - start), y[start - 1:-1]])
    coef, sse, *_ = np.linalg.lstsq(design, y[start:], rcond=None)
    assert grid["(1,0,0)"].sse == pytest.approx(float(sse[0])) and grid["(1,0,0)"].n == len(y) - start
    assert grid["(1,0,0)"].aic < grid["(0,0,0)"].aic


def test_long_orders_plan_in_reasonable_time(spark, noise):
    df = table(spark, {"walk": noise["walk"]})
    assert ar.fit(df, ar.Order(5, 1, 5), ["k"]).coefficients.first().n > 200
    assert ar.fit(df, ar.Order(3, 1, 3, 1, 1, 1, 52, trend=True), ["k"]).coefficients.first().n > 100


def test_trend_with_a_break_and_a_season(spark):
    days = np.arange(3 * 365)
    y = 10 + 0.02 * days + np.where(days > 500, 0.05 * (days - 500), 0) + 3 * np.sin(2 * np.pi * days / 365.25) + (days % 7 == 0)
    df = table(spark, {"a": y, "b": 2 * y}, step=1)
    shape = tr.Shape(changepoint_scale=0.5)
    fitted = tr.fit(df.where(F.col("ds") < START + dt.timedelta(days=1000)), shape, ["k"])
    out = {(r.k, r.ds): r for r in tr.predict(df, fitted, shape, ["k"]).collect()}
    errors = [abs(r.yhat - r.y) / 60 for r in out.values() if r.ds >= START + dt.timedelta(days=1000)]
    assert len(errors) == 190 and np.mean(errors) < 0.05
    row = out[("a", START + dt.timedelta(days=70))]
    assert row.yhat == pytest.approx(row.trend + row.yearly + row.weekly)


def test_given_changepoints_and_capacity(spark):
    days = np.arange(200)
    bent = np.where(days < 100, 5.0, 5.0 + (days - 100) * 0.5)
    shape = tr.Shape(changepoint_dates=(str(START + dt.timedelta(days=100)),), yearly=0, weekly=0, changepoint_scale=10.0)
    df = table(spark, {"a": bent}, step=1)
    worst = tr.residuals(df, tr.predict(df, tr.fit(df, shape), shape)).agg(F.max(F.abs("resid"))).first()[0]
    assert worst < 0.1
    growth = 230 / (1 + np.exp(-(days - 80) / 20))
    limited = tr.Shape(changepoints=1, yearly=0, weekly=0, capacity=230.0)
    df = table(spark, {"a": growth}, step=1)
    far = tr.predict(table(spark, {"a": np.zeros(600)}, step=1), tr.fit(df, limited, ["k"]), limited, ["k"])
    assert far.agg(F.max("yhat")).first()[0] <= 230.0


def test_rolling_origin_counts_and_scores(spark):
    y = [float(i) for i in range(200)]
    shape = tr.Shape(changepoints=2, yearly=0, weekly=0)
    got = tr.rolling_origin(table(spark, {"a": y}, step=1), shape, [(0.1, 1.0), (0.001, 1.0)], 10, 100, 30).collect()
    assert len(got) == 2 and all(r.n == 3 * 10 and r.rmse < 1.0 for r in got)


def test_preparation_and_pairs(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), 1.0), (dt.datetime(2024, 1, 1, 9), 3.0), (dt.datetime(2024, 1, 3), 5.0)], "ts timestamp, v double")
    assert [tuple(r) for r in sp.prepare(df, "ts", "v").orderBy("ds").collect()] == [(dt.date(2024, 1, 1), 2.0), (dt.date(2024, 1, 3), 5.0)]
    assert [r.y for r in sp.regular(df, "ts", "v", "day").orderBy("ds").collect()] == [4.0, 0.0, 5.0]
    pair = spark.createDataFrame([(START + dt.timedelta(i), float(a), float(b)) for i, (a, b) in enumerate([(1, 2), (3, 5), (2, 4), (6, 6)])], "ds date, a double, b double")
    row = sp.paired_correlation(pair, "a", "b").first()
    assert row.levels == pytest.approx(np.corrcoef([1, 3, 2, 6], [2, 5, 4, 6])[0, 1])
    assert row.differences == pytest.approx(np.corrcoef([2, -1, 4], [3, -1, 2])[0, 1])


def _simulated(n, season, ar, seasonal_ar, ma, seasonal_ma, seed):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 400)
    w = np.zeros(n + 400)
    for t in range(season + 1, len(w)):
        w[t] = (ar * w[t - 1] + seasonal_ar * w[t - season] - ar * seasonal_ar * w[t - season - 1]
                + e[t] + ma * e[t - 1] + seasonal_ma * e[t - season] + ma * seasonal_ma * e[t - season - 1])
    return np.cumsum(w[400:])


def test_multiplicative_season_is_recovered(spark):
    start = dt.date(1990, 1, 1)
    truth = {"ar_1": 0.5, "ar_52": 0.6, "ma_1": 0.3, "ma_52": 0.4}
    rows = [(k, start + dt.timedelta(7 * i), float(v)) for k in range(4) for i, v in enumerate(_simulated(2000, 52, 0.5, 0.6, 0.3, 0.4, k))]
    df = spark.createDataFrame(rows, "k int, ds date, y double")
    model = ar.fit(df, ar.Order(1, 1, 1, 1, 0, 1, 52), ["k"])
    table = model.interval_table().collect()
    assert len(table) == 16
    within = [abs(r.estimate - truth[r.term]) <= 2 * r.stderr for r in table]
    assert sum(within) >= 14 and all(abs(r.estimate - truth[r.term]) <= 3.5 * r.stderr for r in table)
    assert all(0.9 < r.sigma2 < 1.1 for r in model.coefficients.collect())


def test_forecast_goes_on_from_the_shocks_of_the_fit(spark):
    order = ar.Order(1, 1, 1, 1, 0, 1, 4)
    y = _simulated(160, 4, 0.4, 0.5, 0.3, 0.2, 9)
    df = spark.createDataFrame([("a", dt.date(2000, 1, 1) + dt.timedelta(7 * i), float(v)) for i, v in enumerate(y)], "k string, ds date, y double")
    model = ar.fit(df, order, ["k"])
    a, sa, b, sb = model.coefficients.first().coef
    past = model.history.orderBy("ds").collect()
    w, e = [r.w or 0.0 for r in past], [r.resid or 0.0 for r in past]
    assert all(r.e == r.resid for r in past)
    # The shocks obey the model's own equation.
    for t in range(20, 160):
        said = a * w[t - 1] + sa * w[t - 4] - a * sa * w[t - 5] + b * e[t - 1] + sb * e[t - 4] + b * sb * e[t - 5]
        assert w[t] - said == pytest.approx(e[t], abs=1e-9) and past[t].fitted == pytest.approx(past[t].y - e[t])
    level, answer = y[-1], []
    for _ in range(7):
        w.append(a * w[-1] + sa * w[-4] - a * sa * w[-5] + b * e[-1] + sb * e[-4] + b * sb * e[-5])
        e.append(0.0)
        level += w[-1]
        answer.append(level)
    assert [r.yhat for r in ar.forecast(model, 7, 7).orderBy("ds").collect()] == pytest.approx(answer)


def test_gaps_leave_out_what_needs_them(spark):
    y = [float(v) for v in _simulated(120, 4, 0.6, 0.0, 0.0, 0.0, 3)]
    rows = [("a", dt.date(2000, 1, 1) + dt.timedelta(i), None if i in (40, 41) else v) for i, v in enumerate(y)] + [("short", dt.date(2000, 1, 1), 1.0)]
    df = spark.createDataFrame(rows, "k string, ds date, y double")
    found = ar.fit(df, ar.Order(1, 1, 0), ["k"]).coefficients.collect()
    assert [r.k for r in found] == ["a"] and found[0].n == 118 - 4
    assert ar.fit(df.limit(0), ar.Order(1, 1, 1), ["k"]).coefficients.collect() == []


@pytest.mark.parametrize("shape", [
    tr.Shape(changepoints=6, yearly=2, weekly=2), tr.Shape(changepoint_dates=("2016-02-01", "2015-07-01", "2031-01-01"), yearly=1, weekly=0),
    tr.Shape(changepoints=3, yearly=0, weekly=1, capacity=60.0)])
def test_rolling_origin_is_a_fit_per_cutoff(spark, shape):
    rng = np.random.default_rng(1)
    data = []
    for k, n in (("a", 500), ("b", 260), ("short", 60)):
        steps = np.cumsum(rng.integers(1, 3, n))
        data += [(k, START + dt.timedelta(int(d)), float(20 + 0.02 * d + 3 * np.sin(d / 58) + rng.normal())) for d in steps]
    df = spark.createDataFrame(data + [("a", START + dt.timedelta(3), None)], "k string, ds date, y double")
    grid = [(0.5, 10.0), (0.001, 0.1)]
    got = {(r.changepoint_scale, r.season_scale): r for r in tr.rolling_origin(df, shape, grid, 30, 150, 70, ["k"]).collect()}
    for c, s in grid:
        one = tr.replace(shape, changepoint_scale=c, season_scale=s)
        squares = []
        for k in ("a", "b", "short"):
            known = [(d, y) for q, d, y in data if q == k]
            cut, first = known[-1][0] - dt.timedelta(30), known[0][0]
            while (cut - first).days >= 150:
                train = spark.createDataFrame([x for x in known if x[0] <= cut], "ds date, y double")
                held = spark.createDataFrame([x for x in known if cut < x[0] <= cut + dt.timedelta(30)], "ds date, y double")
                squares += [(r.y - r.yhat) ** 2 for r in tr.predict(held, tr.fit(train, one), one).collect()]
                cut -= dt.timedelta(70)
        assert got[c, s].n == len(squares) and got[c, s].rmse == pytest.approx(np.sqrt(np.mean(squares)), rel=1e-6)
    assert [(r.rmse, r.n) for r in tr.rolling_origin(df.limit(0), shape, grid).collect()] == [(None, 0)] * 2
