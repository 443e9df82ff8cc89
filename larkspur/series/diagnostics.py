"""Autocorrelation, unit roots and residual checks, per key."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.distributions import normal_cdf_value
from larkspur.functions.linalg import solve_normal_equations, with_intercept
from larkspur.operators.chartdata import histogram
from larkspur.series.prep import ordered
from larkspur.session import checkpointed


def autocorrelation(df: DataFrame, lags: int, column: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """(key..., lag, acf) for lags 0 … ``lags``; one sort serves every lag.

    Lags as long as the series have no row; a flat series has nulls.
    """
    w = ordered(by)
    values = df.where(F.col(column).isNotNull())
    means = values.groupBy(*by).agg(F.avg(column).alias("_mean"), F.count(F.lit(1)).alias("_n"))
    if by:
        centred = values.join(means, list(by))
    else:
        centred = values.withColumn("_row", means.select(F.struct("_mean", "_n")).scalar()).select("*", "_row.*")
    centred = centred.select(*by, "ds", "_n", (F.col(column) - F.col("_mean")).alias("_e"))
    shifted = centred.select(*by, "_n", "_e", *[F.lag("_e", k).over(w).alias(f"_l{k}") for k in range(1, lags + 1)])
    total = F.sum(F.col("_e") * F.col("_e"))
    sums = shifted.groupBy(*by).agg(
        F.first("_n").alias("_n"),
        (total == 0).alias("_flat"),
        F.array(F.try_divide(total, total), *[F.try_divide(F.sum(F.col("_e") * F.col(f"_l{k}")), total) for k in range(1, lags + 1)]).alias("_acf"),
    )
    cells = sums.select(*by, "_flat", F.posexplode("_acf").alias("lag", "acf"))
    return cells.where(F.col("acf").isNotNull() | F.col("_flat")).drop("_flat")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _partial(acf: pd.Series) -> pd.Series:
    """Durbin-Levinson recursion over an ordered autocorrelation array."""
    out = []
    for values in acf:
        r = np.asarray(values, dtype=float)
        phi, variance, result = np.zeros(0), 1.0, [1.0 if len(r) and not np.isnan(r[0]) else None]
        for k in range(1, len(r)):
            reflection = (r[k] - phi @ r[k - 1:0:-1]) / variance if variance > 0 else np.nan
            phi = np.append(phi - reflection * phi[::-1], reflection)
            variance *= 1.0 - reflection**2
            result.append(None if np.isnan(reflection) else float(reflection))
        out.append(result)
    return pd.Series(out)


def partial_autocorrelation(df: DataFrame, lags: int, column: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """(key..., lag, pacf) from the autocorrelations; an array of ``lags + 1`` numbers per key."""
    acf = autocorrelation(df, lags, column, by)
    packed = acf.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("lag", "acf"))).alias("_pairs"))
    return packed.withColumn("_pacf", _partial(F.col("_pairs.acf"))).select(
        *by, F.posexplode("_pacf").alias("lag", "pacf")
    )


def durbin_watson(df: DataFrame, column: str = "resid", by: Sequence[str] = ()) -> DataFrame:
    """One number per key; null where all residuals are zero."""
    e = F.col(column)
    steps = df.where(e.isNotNull()).select(*by, e.alias("_e"), (e - F.lag(e).over(ordered(by))).alias("_d"))
    return steps.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("_d") * F.col("_d")), F.sum(F.col("_e") * F.col("_e"))).alias("durbin_watson")
    )


def residual_checks(df: DataFrame, column: str = "resid", by: Sequence[str] = ()) -> DataFrame:
    """Moments of the residuals per key, next to the Durbin-Watson statistic."""
    c = F.col(column)
    moments = df.where(c.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
        F.skewness(c).alias("skewness"), F.kurtosis(c).alias("kurtosis"),
    )
    watson = durbin_watson(df, column, by)
    if by:
        return moments.join(watson, list(by))
    return moments.withColumn("durbin_watson", watson.select("durbin_watson").scalar())


def residual_histogram(df: DataFrame, bins: int, column: str = "resid", by: Sequence[str] = ()) -> DataFrame:
    return histogram(df, column, bins, by)


# ---------------------------------------------------------------- unit root

# Published response-surface coefficients for the test with a constant.
P_VALUE_LOW, P_VALUE_HIGH, P_VALUE_SWITCH = -18.83, 2.74, -1.61
P_VALUE_SMALL = [2.1659, 1.4412, 0.038269]
P_VALUE_LARGE = [1.7339, 0.93202, -0.12745, -0.010368]
CRITICAL = {
    "critical_1": [-3.43035, -6.5393, -16.786, -79.433],
    "critical_5": [-2.86154, -2.8903, -4.234, -40.040],
    "critical_10": [-2.56677, -1.5384, -2.809, 0.0],
}


def unit_root_p(statistic: float) -> float:
    if statistic > P_VALUE_HIGH:
        return 1.0
    if statistic < P_VALUE_LOW:
        return 0.0
    weights = P_VALUE_SMALL if statistic <= P_VALUE_SWITCH else P_VALUE_LARGE
    return normal_cdf_value(sum(w * statistic**i for i, w in enumerate(weights)))


@F.pandas_udf(T.DoubleType())
def _p_value(statistic: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(s) else unit_root_p(float(s)) for s in statistic], dtype="float64")


def _lagged_steps(y: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Steps of a series, and beside them the level before and ``most`` earlier steps; not a number where there is none."""
    d = np.diff(y)
    x = np.full((len(d), most + 1), np.nan)
    x[:, 0] = y[:-1]
    for k in range(1, most + 1):
        x[k:, k] = d[: len(d) - k] if k < len(d) else []
    return d, x


def unit_root_of(y: np.ndarray, most: int, lag: int | None) -> tuple[float, int, int] | None:
    """(statistic, lags, rows) of one series; None if it is too short."""
    if len(y) < 3:
        return None
    # A constant is in the test, so the level may be taken around the series' mean.
    d, x = _lagged_steps(y - y.mean(), most)
    if lag is None:
        common = slice(most, None)
        rows, target = np.column_stack([np.ones(len(d)), x])[common], d[common]
        if len(target) <= rows.shape[1]:
            return None
        # Nested fits are corners of one system.
        gram, moment, total, n = rows.T @ rows, rows.T @ target, float(target @ target), len(target)
        scores = []
        for size in range(2, rows.shape[1] + 1):
            sse = solve_normal_equations(gram[:size, :size], moment[:size], total, n)[2]
            scores.append(n * math.log(max(sse, 1e-300) / n) + 2 * size)
        lag = int(np.argmin(scores))
    rows, target = x[lag:, : lag + 1], d[lag:]
    if len(target) <= lag + 2:
        return None
    apart, off = rows - rows.mean(axis=0), target - target.mean()
    coef, stderr, _, _ = with_intercept(apart.T @ apart, apart.T @ off, float(off @ off), len(target), rows.mean(axis=0), float(target.mean()))
    if not stderr[1] > 0:
        return None
    return float(coef[1] / stderr[1]), lag, len(target)


def unit_root_test(
    df: DataFrame, column: str = "y", by: Sequence[str] = (), max_lag: int | None = None, lag: int | None = None
) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant, per key.

    The number of lagged differences is chosen by AIC up to ``max_lag`` (default
    ``ceil(12 (n/100)^(1/4))`` of the longest series) unless ``lag`` fixes it. A
    series is one row, bounded by its calendar. A keyed series too short for the
    test has a row with its length and nulls.
    """
    values = df.where(F.col(column).isNotNull())
    points = F.array_sort(F.collect_list(F.struct("ds", F.col(column).cast("double").alias("v"))))
    packed = values.groupBy(*by).agg(points.alias("_t"))
    if lag is None and max_lag is None:
        packed = checkpointed(packed)
        longest = packed.agg(F.max(F.size("_t"))).first()[0] or 0
        max_lag = math.ceil(12 * (longest / 100) ** 0.25)
    most = lag if lag is not None else max_lag

    @F.pandas_udf("statistic double, lags int, n_obs long")
    def run(series: pd.Series) -> pd.DataFrame:
        found = [unit_root_of(np.asarray(y, dtype=float), most, lag) for y in series]
        return pd.DataFrame({
            "statistic": pd.array([None if f is None else f[0] for f in found], "Float64"), "lags": pd.array([None if f is None else f[1] for f in found], "Int32"),
            "n_obs": pd.array([len(y) if f is None else f[2] for f, y in zip(found, series)], "Int64")})

    tested = packed.select(*by, run(F.col("_t.v")).alias("_r")).select(*by, "_r.*")
    if not by:
        tested = tested.where("statistic IS NOT NULL")
    valid = F.when(F.col("statistic").isNotNull(), F.col("n_obs"))
    critical = [
        sum((F.lit(c) / F.pow(valid, F.lit(i)) for i, c in enumerate(cs[1:], 1)), F.lit(cs[0])).alias(name)
        for name, cs in CRITICAL.items()
    ]
    return tested.select(*by, "statistic", _p_value("statistic").alias("p_value"), "lags", "n_obs", *critical)
