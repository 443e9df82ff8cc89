"""ARIMA with multiplicative seasonal terms and outside regressors, for many series and many orders at once.

Fitted by the regression of Hannan and Rissanen in three steps: a long
autoregression estimates the shocks, a least-squares fit on lagged values and
lagged shocks starts the coefficients, and regressions of the shocks on their own
derivatives correct them until the conditional sum of squares rests. Estimates
differ from maximum likelihood in small samples. The grid of orders compares the
second step's fits, with seasonal terms as extra lags.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.linalg import gaussian_aic, grouped_ols, linear_score, solve_normal_equations
from larkspur.series.prep import differences, ordered
from larkspur.session import checkpointed


def _lagged_ones(weights: np.ndarray, step: int) -> np.ndarray:
    """1 + weights[0] B^step + weights[1] B^(2 step) + ... as an array of coefficients."""
    out = np.zeros(1 + step * len(weights))
    out[0] = 1.0
    if len(weights):
        out[step::step] = weights
    return out


@dataclass(frozen=True)
class Order:
    p: int = 0
    d: int = 0
    q: int = 0
    seasonal_p: int = 0
    seasonal_d: int = 0
    seasonal_q: int = 0
    season: int = 0
    trend: bool = False

    @property
    def ar_lags(self) -> list[int]:
        return [*range(1, self.p + 1), *[self.season * i for i in range(1, self.seasonal_p + 1)]]

    @property
    def ma_lags(self) -> list[int]:
        return [*range(1, self.q + 1), *[self.season * i for i in range(1, self.seasonal_q + 1)]]

    @property
    def reach(self) -> tuple[int, int]:
        """The longest lag of the multiplied-out polynomials of values and of shocks."""
        return self.p + self.season * self.seasonal_p, self.q + self.season * self.seasonal_q

    def unfold(self, coef: np.ndarray, n_exog: int) -> tuple[np.ndarray, ...]:
        """Coefficients of the constant, trend and regressors; of lags and seasonal lags of values; of shocks."""
        cuts = np.cumsum([int(self.constant) + int(self.trend) + n_exog, self.p, self.seasonal_p, self.q])
        return tuple(np.split(np.asarray(coef, dtype=float), cuts))

    def polynomials(self, coef: np.ndarray, n_exog: int) -> tuple[np.ndarray, np.ndarray]:
        """Weights of lags 1, 2, ... of values and of shocks, seasonal parts multiplied out."""
        _, ar, seasonal_ar, ma, seasonal_ma = self.unfold(coef, n_exog)
        values = np.convolve(_lagged_ones(-ar, 1), _lagged_ones(-seasonal_ar, self.season))
        shocks = np.convolve(_lagged_ones(ma, 1), _lagged_ones(seasonal_ma, self.season))
        return -values[1:], shocks[1:]

    @property
    def lost(self) -> int:
        return self.d + self.seasonal_d * self.season

    @property
    def constant(self) -> bool:
        return self.lost == 0

    @property
    def long_lags(self) -> list[int]:
        """Lags of the first-step autoregression."""
        if not self.ma_lags:
            return []
        short = list(range(1, 2 * max(self.p, self.q, 2) + 1))
        seasonal = [self.season] if self.seasonal_p or self.seasonal_q else []
        return [*short, *[s for s in seasonal if s not in short]]

    @property
    def start(self) -> int:
        """Rows at the head of a series that the second step cannot use."""
        return self.lost + max([0, *self.long_lags]) + max([0, *self.ar_lags, *self.ma_lags])

    @property
    def label(self) -> str:
        tail = f"({self.seasonal_p},{self.seasonal_d},{self.seasonal_q},{self.season})" if self.season else ""
        return f"({self.p},{self.d},{self.q}){tail}" + (" t" if self.trend else "")


@dataclass
class Fit:
    """``coefficients``: one row per key. ``history``: the series with ``fitted`` and ``resid``."""

    order: Order
    terms: list[str]
    coefficients: DataFrame
    history: DataFrame
    by: list[str] = field(default_factory=list)
    exog: list[str] = field(default_factory=list)

    def interval_table(self, z: float = 1.959963984540054) -> DataFrame:
        """Coefficients with standard errors and the interval ``estimate ± z * stderr``."""
        names = F.array(*[F.lit(n) for n in self.terms])
        rows = self.coefficients.select(*self.by, F.posexplode(F.arrays_zip("coef", "stderr")).alias("place", "c"))
        estimate, error = F.col("c.coef"), F.col("c.stderr")
        return rows.select(
            *self.by, F.element_at(names, F.col("place") + 1).alias("term"), estimate.alias("estimate"),
            error.alias("stderr"), (estimate - z * error).alias("low"), (estimate + z * error).alias("high"),
        )


def _attach(df: DataFrame, table: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    if by:
        return df.join(table.select(*by, *columns), list(by))
    return df.withColumn("_fit", table.select(F.struct(*columns)).scalar()).select("*", *[f"_fit.{c}" for c in columns]).drop("_fit")


def _worked(df: DataFrame, order: Order, by: Sequence[str], exog: Sequence[str]) -> DataFrame:
    """Differenced series ``w`` (and regressors), numbered; the undefined head is removed."""
    out = differences(df, "y", order.d, order.seasonal_d, order.season, by, "w")
    for name in exog:
        out = differences(out, name, order.d, order.seasonal_d, order.season, by, f"x_{name}")
    return out.withColumn("place", F.row_number().over(ordered(by)))


def _shocks(worked: DataFrame, order: Order, by: Sequence[str]) -> DataFrame:
    """Add ``e``: residuals of the long autoregression (null where it has no full set of lags)."""
    if not order.ma_lags:
        return worked.withColumn("e", F.lit(None).cast("double"))
    w = ordered(by)
    names = [f"_w{k}" for k in order.long_lags]
    lagged = worked.withColumns({n: F.lag("w", k).over(w) for n, k in zip(names, order.long_lags)})
    first = grouped_ols(lagged, "w", names, by)
    scored = _attach(lagged, first.withColumnRenamed("coef", "_long"), by, ["_long"])
    return scored.withColumn("e", F.col("w") - linear_score(F.col("_long"), names)).drop("_long", *names)


def _lag(x: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros_like(x)
    out[k:] = x[: len(x) - k] if k else x
    return out


def _filtered(x: np.ndarray, weights: np.ndarray, step: int) -> np.ndarray:
    """x plus its lags of ``step``, 2 ``step``, ... by ``weights``."""
    return x + sum((w * _lag(x, step * (i + 1)) for i, w in enumerate(weights)), np.zeros_like(x))


def _recursion(given: np.ndarray, weights: np.ndarray, usable: np.ndarray) -> np.ndarray:
    """out[t] = given[t] - sum of weights[k] out[t - 1 - k]; zero where the series cannot be used."""
    lags = np.flatnonzero(weights)
    if not len(lags):
        return np.where(usable.reshape(-1, *[1] * (given.ndim - 1)), given, 0.0)
    reach, share = len(weights), weights[lags]
    out = np.zeros((len(given) + reach, *given.shape[1:]))
    back = reach - 1 - lags
    for t in np.flatnonzero(usable):
        out[t + reach] = given[t] - share @ out[t + back]
    return out[reach:]


def _shocks_of(order: Order, coef: np.ndarray, w: np.ndarray, base: np.ndarray, usable: np.ndarray) -> np.ndarray:
    values, shocks = order.polynomials(coef, base.shape[1] - int(order.constant) - int(order.trend))
    given = w - base @ coef[: base.shape[1]] - sum((v * _lag(w, k) for k, v in enumerate(values, 1) if v), np.zeros_like(w))
    return _recursion(given, shocks, usable)


def _slopes(order: Order, coef: np.ndarray, w: np.ndarray, base: np.ndarray, e: np.ndarray, usable: np.ndarray) -> np.ndarray:
    """Derivatives of the shocks by every coefficient."""
    _, ar, seasonal_ar, ma, seasonal_ma = order.unfold(coef, base.shape[1] - int(order.constant) - int(order.trend))
    by_season, by_short = _filtered(w, -seasonal_ar, order.season), _filtered(w, -ar, 1)
    e_season, e_short = _filtered(e, seasonal_ma, order.season), _filtered(e, ma, 1)
    columns = [
        *base.T, *[_lag(by_season, k) for k in range(1, order.p + 1)], *[_lag(by_short, order.season * k) for k in range(1, order.seasonal_p + 1)],
        *[_lag(e_season, k) for k in range(1, order.q + 1)], *[_lag(e_short, order.season * k) for k in range(1, order.seasonal_q + 1)],
    ]
    _, shocks = order.polynomials(coef, base.shape[1] - int(order.constant) - int(order.trend))
    return _recursion(-np.column_stack(columns), shocks, usable)


def _least_squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    scale = np.sqrt((x * x).sum(axis=0))
    scale[scale == 0] = 1.0
    return np.linalg.lstsq(x / scale, y, rcond=1e-10)[0] / scale


def _started(order: Order, w: np.ndarray, base: np.ndarray, known: np.ndarray, usable: np.ndarray) -> np.ndarray:
    """The first two steps: shocks of a long autoregression, then one regression on lagged values and shocks."""
    e = np.zeros_like(w)
    if order.ma_lags:
        lags = order.long_lags
        whole = known.copy()
        for k in lags:
            whole &= _lag(known.astype(float), k) > 0
        if whole.sum() > len(lags) + 1:
            x = np.column_stack([np.ones(len(w)), *[_lag(w, k) for k in lags]])
            e = np.where(whole, w - x @ _least_squares(x[whole], w[whole]), 0.0)
            usable = usable & whole
    x = np.column_stack([base, *[_lag(w, k) for k in order.ar_lags], *[_lag(e, k) for k in order.ma_lags]])
    return _least_squares(x[usable], w[usable]) if usable.any() else np.zeros(x.shape[1])


def fit_arrays(order: Order, w: np.ndarray, exog: np.ndarray, steps: int = 60) -> dict | None:
    """Fit one differenced series: coefficients, standard errors, shocks and sums; None without a usable value.

    A value counts if it and all lags it needs are there; shocks before the first
    such value, and at values that do not count, are zero.
    """
    known = ~np.isnan(w) & ~np.isnan(exog).any(axis=1)
    usable = known.copy()
    for k in range(order.p + 1):
        for j in range(order.seasonal_p + 1):
            lag = k + j * order.season
            if lag:
                usable &= _lag(known.astype(float), lag) > 0
    if not usable.any():
        return None
    w = np.where(known, w, 0.0)
    place = np.arange(1, len(w) + 1, dtype=float)
    base = np.column_stack([np.ones((len(w), int(order.constant))), *([place] if order.trend else []), np.nan_to_num(exog)])
    width = base.shape[1] + order.p + order.seasonal_p + order.q + order.seasonal_q
    n = int(usable.sum())

    def cost(coef: np.ndarray) -> tuple[float, np.ndarray]:
        with np.errstate(all="ignore"):
            e = _shocks_of(order, coef, w, base, usable)
            sse = float(e[usable] @ e[usable])
        return (sse if np.isfinite(sse) else np.inf), e

    plain = np.zeros(width)
    plain[: base.shape[1]] = _least_squares(base[usable], w[usable]) if base.shape[1] else []
    coef = min((_started(order, w, base, known, usable), plain), key=lambda c: cost(c)[0])
    sse, e = cost(coef)
    for _ in range(steps if width else 0):
        move, size = -_least_squares(_slopes(order, coef, w, base, e, usable)[usable], e[usable]), 1.0
        while size > 1e-6:
            lower, shocks = cost(coef + size * move)
            if lower < sse:
                break
            size /= 2
        if size <= 1e-6:
            break
        gain, coef, sse, e = sse - lower, coef + size * move, lower, shocks
        if gain <= 1e-8 * sse:
            break
    stderr, rank = np.zeros(0), 0
    if width:
        slopes = _slopes(order, coef, w, base, e, usable)[usable]
        scale = np.sqrt((slopes * slopes).sum(axis=0))
        scale[scale == 0] = 1.0
        gram = (slopes / scale).T @ (slopes / scale)
        rank = int(np.linalg.matrix_rank(gram, tol=1e-10, hermitian=True))
        spread = np.clip(np.diag(np.linalg.pinv(gram, rcond=1e-12, hermitian=True)), 0, None)
        stderr = np.sqrt(sse / (n - rank) * spread) / scale if n > rank else np.full(width, np.nan)
    used = w[usable]
    total = float(((used - used.mean()) ** 2).sum() if order.constant else used @ used)
    return {"coef": coef, "stderr": stderr, "sse": sse, "n": n, "rank": rank, "total": total, "resid": np.where(usable, e, np.nan)}


_FITTED = T.StructType([
    T.StructField("coef", T.ArrayType(T.DoubleType())), T.StructField("stderr", T.ArrayType(T.DoubleType())), T.StructField("sse", T.DoubleType()),
    T.StructField("n", T.LongType()), T.StructField("rank", T.IntegerType()), T.StructField("total", T.DoubleType()),
    T.StructField("resid", T.ArrayType(T.DoubleType())),
])


def _fitter(order: Order, n_exog: int):
    def plain(values) -> list:
        return [None if np.isnan(v) else float(v) for v in values]

    @F.pandas_udf(_FITTED)
    def run(ws: pd.Series, xs: pd.Series) -> pd.DataFrame:
        rows = []
        for w, x in zip(ws, xs):
            w = np.array(w, dtype=float)
            found = fit_arrays(order, w, np.array(x, dtype=float).reshape(len(w), n_exog))
            rows.append([None] * 7 if found is None else [
                plain(found["coef"]), plain(found["stderr"]), found["sse"], found["n"], found["rank"], found["total"], plain(found["resid"])])
        return pd.DataFrame(rows, columns=[f.name for f in _FITTED])

    return run


def fit(df: DataFrame, order: Order, by: Sequence[str] = (), exog: Sequence[str] = ()) -> Fit:
    """Fit every series of ``(key..., ds, y, exog...)``.

    A series is one row of arrays, bounded by its calendar, so series spread over
    tasks. One set of shocks serves the fit, its history and its forecasts. Series
    without a value that has all of its lags are left out.
    """
    worked = _worked(df, order, by, exog)
    point = F.struct("ds", "y", *exog, "place", F.col("w").cast("double").alias("w"), F.array(*[F.col(f"x_{n}").cast("double") for n in exog]).cast("array<double>").alias("_x"))
    packed = worked.groupBy(*by).agg(F.array_sort(F.collect_list(point)).alias("_t"))
    run = _fitter(order, len(exog))
    found = checkpointed(packed.withColumn("_f", run(F.col("_t.w"), F.flatten(F.col("_t._x")))).where("_f.n IS NOT NULL"))
    terms = [*["(constant)"] * order.constant, *["trend"] * order.trend, *[name + "_effect" for name in exog],
             *[f"ar_{k}" for k in order.ar_lags], *[f"ma_{k}" for k in order.ma_lags]]
    n, rank, sse, total = (F.col(f"_f.{c}") for c in ("n", "rank", "sse", "total"))
    table = found.select(
        *by, n.alias("n"), F.col("_f.coef").alias("coef"), F.col("_f.stderr").alias("stderr"), sse.alias("sse"), rank.alias("rank"),
        (1 - sse / F.when(total != 0, total)).alias("r2"), (sse / F.when(n > rank, n - rank)).alias("sigma2"), gaussian_aic(sse, n, rank + 1).alias("aic"))
    told = found.select(*by, F.explode(F.arrays_zip(F.col("_t").alias("t"), F.col("_f.resid").alias("resid"))).alias("p"))
    resid = F.col("p.resid")
    history = told.select(
        *by, "p.t.ds", "p.t.y", *[f"p.t.{x}" for x in exog], "p.t.place", "p.t.w", resid.alias("e"),
        (F.col("p.t.y") - resid).alias("fitted"), resid.alias("resid"))
    return Fit(order, terms, table, history, list(by), list(exog))


# ---------------------------------------------------------------- forecast


def _forecaster(order: Order, terms: list[str], n_exog: int):
    offset = (1 if order.constant else 0) + (1 if order.trend else 0)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(coef: pd.Series, ys: pd.Series, ws: pd.Series, es: pd.Series, last: pd.Series, steps: pd.Series, future: pd.Series) -> pd.Series:
        out = []
        for c, y, w, e, place, h, x in zip(coef, ys, ws, es, last, steps, future):
            values, shocks = (p.tolist() for p in order.polynomials(np.array(c, dtype=float), n_exog))
            levels = [[float(v) for v in y]]
            lags = [1] * order.d + [order.season] * order.seasonal_d
            for lag in lags:
                previous = levels[-1]
                levels.append([b - a for a, b in zip(previous[:-lag], previous[lag:])])
            w, e = [float(v) for v in w], [0.0 if v is None else float(v) for v in e]
            x = np.asarray(list(x), dtype=float).reshape(int(h), n_exog) if n_exog else None
            answer = []
            for step in range(int(h)):
                value = 0.0
                if order.constant:
                    value += c[0]
                if order.trend:
                    value += c[1 if order.constant else 0] * (place + step + 1)
                if n_exog:
                    value += float(np.dot(c[offset:offset + n_exog], x[step]))
                value += sum(a * w[-k] for k, a in enumerate(values, 1) if a)
                value += sum(b * e[-k] for k, b in enumerate(shocks, 1) if b)
                w.append(value)
                e.append(0.0)
                for depth in range(len(lags) - 1, -1, -1):
                    value += levels[depth][-lags[depth]]
                    levels[depth].append(value)
                answer.append(float(value))
            out.append(answer)
        return pd.Series(out)

    return run


def forecast(model: Fit, h: int, step_days: int, future_exog: DataFrame | None = None) -> DataFrame:
    """(key..., ds, yhat) for the h periods after each series.

    Only the tail a recursion needs (at most the longest lag) is gathered per
    key. ``future_exog`` holds ``(key..., ds, exog...)`` for those periods, in differenced form not needed.
    """
    order, by = model.order, model.by
    need = max([order.lost + 1, *order.reach])
    back = W.partitionBy(*by).orderBy(F.col("ds").desc())
    tail = model.history.withColumn("_back", F.row_number().over(back)).where(F.col("_back") <= need)
    packed = tail.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("ds", "y", F.coalesce("w", F.lit(0.0)).alias("w"), F.coalesce("resid", F.lit(0.0)).alias("e")))).alias("t"),
        F.max("ds").alias("_last"), F.max("place").alias("_place"),
    )
    if model.exog:
        if future_exog is None:
            raise ValueError("a model with regressors needs their future values")
        future = _future_regressors(model, future_exog, h)
        packed = packed.join(future, list(by)) if by else packed.withColumn("x", future.select("x").scalar())
    else:
        packed = packed.withColumn("x", F.array().cast("array<double>"))
    ready = _attach(packed, model.coefficients, by, ["coef"])
    run = _forecaster(order, model.terms, len(model.exog))
    path = ready.withColumn("path", run("coef", F.col("t.y"), F.col("t.w"), F.col("t.e"), "_place", F.lit(h), "x"))
    steps = path.select(*by, "_last", F.posexplode("path").alias("step", "yhat"))
    return steps.select(*by, F.date_add("_last", ((F.col("step") + 1) * step_days).cast("int")).alias("ds"), "yhat")


def _future_regressors(model: Fit, future: DataFrame, h: int) -> DataFrame:
    """Differenced regressor values of the forecast periods, flattened per key."""
    order, by = model.order, model.by
    both = model.history.select(*by, "ds", *model.exog, F.lit(0).alias("_new")).unionByName(
        future.select(*by, "ds", *model.exog, F.lit(1).alias("_new"))
    )
    for name in model.exog:
        both = differences(both, name, order.d, order.seasonal_d, order.season, by, f"x_{name}")
    values = F.array(*[F.col(f"x_{n}") for n in model.exog])
    return both.where("_new = 1").groupBy(*by).agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ds", values.alias("v")))), lambda s: s["v"])).alias("x")
    )


# ---------------------------------------------------------------- grid


def grid_aic(df: DataFrame, orders: Sequence[Order], by: Sequence[str] = ()) -> DataFrame:
    """(key..., params, n, sse, aic) for every order, all on the same stretch of each series.

    Orders that differ alike share their shocks and one table of cross products:
    every order is a corner of it, so a row is read once however many orders there
    are. A keyed series too short for the stretch has its orders with nulls.
    """
    start = max(o.start for o in orders)
    parts = []
    for lost in sorted({(o.d, o.seasonal_d, o.season if o.seasonal_d else 0) for o in orders}):
        mine = [o for o in orders if (o.d, o.seasonal_d, o.season if o.seasonal_d else 0) == lost]
        widest = max(mine, key=lambda o: (len(o.long_lags), max([0, *o.long_lags])))
        shocked = _shocks(_worked(df, widest, by, ()), widest, by)
        lags = sorted({k for o in mine for k in o.ar_lags})
        shocks = sorted({k for o in mine for k in o.ma_lags})
        terms = ["constant", "trend", *[f"w{k}" for k in lags], *[f"e{k}" for k in shocks]]
        subsets = [[
            *[terms.index("constant")] * o.constant, *[terms.index("trend")] * o.trend,
            *[terms.index(f"w{k}") for k in o.ar_lags], *[terms.index(f"e{k}") for k in o.ma_lags],
        ] for o in mine]
        w = ordered(by)
        wide = F.array(
            F.lit(1.0), F.col("place").cast("double"), *[F.coalesce(F.lag("w", k).over(w), F.lit(0.0)) for k in lags],
            *[F.coalesce(F.lag("e", k).over(w), F.lit(0.0)) for k in shocks],
        )
        rows = shocked.withColumn("x", wide).where((F.col("place") > start) & F.col("w").isNotNull())
        fitted = rows.groupBy(*by).agg(_fit_subsets(subsets)("w", "x").alias("f"))
        if by:
            fitted = df.select(*by).distinct().join(fitted, list(by), "left")
        labels = F.array(*[F.lit(o.label) for o in mine])
        pairs = F.transform(labels, lambda label, i: F.struct(label.alias("params"), F.get("f", i).alias("f")))
        parts.append(fitted.select(*by, F.explode(pairs).alias("o")).select(*by, "o.*"))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    sse, n, rank = F.col("f")[0], F.col("f")[1], F.col("f")[2]
    return stacked.select(*by, "params", n.cast("long").alias("n"), sse.alias("sse"), gaussian_aic(sse, n, rank + 1).alias("aic"))


def _fit_subsets(subsets: Sequence[Sequence[int]]):
    """Least squares on chosen places of one feature array: sse, n and rank for each choice."""

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
    def run(y: pd.Series, x: pd.Series) -> list:
        target = y.to_numpy(dtype=float)
        rows = np.stack([np.asarray(v, dtype=float) for v in x])
        gram, moment, total, n = rows.T @ rows, rows.T @ target, float(target @ target), len(target)
        out = []
        for chosen in subsets:
            if not len(chosen):
                out.append([total, float(n), 0.0])
                continue
            _, _, sse, rank = solve_normal_equations(gram[np.ix_(chosen, chosen)], moment[list(chosen)], total, n)
            out.append([float(sse), float(n), float(rank)])
        return out

    return run


def best_orders(grid: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The order with the lowest AIC per key; null where no order could be fitted."""
    return grid.groupBy(*by).agg(F.min_by("params", "aic").alias("params"), F.min("aic").alias("aic"))


def seasonal_walk(df: DataFrame, season: int, by: Sequence[str] = ()) -> DataFrame:
    """Orders (0,1,0)(0,1,0,season): last value plus last season's step; exact, by windows alone."""
    w = ordered(by)
    guess = F.lag("y", 1).over(w) + F.lag("y", season).over(w) - F.lag("y", season + 1).over(w)
    return df.withColumn("fitted", guess).withColumn("resid", F.col("y") - F.col("fitted"))


def seasonal_walk_forecast(df: DataFrame, season: int, h: int, step_days: int, by: Sequence[str] = ()) -> DataFrame:
    """(key..., ds, yhat) of the seasonal random walk."""
    return forecast(fit(df, Order(d=1, seasonal_d=1, season=season), by), h, step_days)
