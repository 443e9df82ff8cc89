"""Trend with changepoints plus yearly and weekly seasons.

A piecewise-linear trend and Fourier terms are columns; their weights are
fitted per series by ridge regression, where the penalties play the part of the
priors on changepoints and seasons. Capacity-limited growth fits the logit.
With ``Shape(sparse=True)`` changes are penalised by their size, so that few remain.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.linalg import solve_normal_equations
from larkspur.models.penalised import coordinate_descent


@dataclass(frozen=True)
class Shape:
    changepoints: int = 25
    changepoint_range: float = 0.8
    changepoint_dates: tuple[str, ...] = ()
    yearly: int = 10
    weekly: int = 3
    changepoint_scale: float = 0.05
    season_scale: float = 10.0
    capacity: float | None = None
    #: Penalise the size of a change, not its square: most changepoints then get no change at all.
    sparse: bool = False

    @property
    def hinges(self) -> int:
        return len(self.changepoint_dates) or self.changepoints

    @property
    def blocks(self) -> dict[str, tuple[int, int]]:
        """(first, width) of each component in the feature array."""
        trend = 2 + self.hinges
        return {
            "trend": (0, trend), "yearly": (trend, 2 * self.yearly), "weekly": (trend + 2 * self.yearly, 2 * self.weekly)
        }

    @property
    def width(self) -> int:
        return 2 + self.hinges + 2 * self.yearly + 2 * self.weekly

    def penalties(self, noise: float) -> np.ndarray:
        """Ridge weights for a noise variance, in units of the scaled series."""
        base, hinge, season = noise / 25.0, noise / self.changepoint_scale**2, noise / self.season_scale**2
        return np.array([base, base, *[hinge] * self.hinges, *[season] * (self.width - 2 - self.hinges)])


def _waves(day: Column, period: float, order: int) -> list[Column]:
    out = []
    for k in range(1, order + 1):
        angle = day * F.lit(2 * math.pi * k / period)
        out += [F.sin(angle), F.cos(angle)]
    return out


def with_design(df: DataFrame, shape: Shape) -> DataFrame:
    """Add ``x``; needs ``ds`` and the series' ``start`` and ``span`` (days)."""
    t = F.datediff("ds", "start") / F.col("span")
    if shape.changepoint_dates:
        knots = [F.datediff(F.lit(d).cast("date"), "start") / F.col("span") for d in shape.changepoint_dates]
    else:
        knots = [F.lit(shape.changepoint_range * (i + 1) / shape.changepoints) for i in range(shape.changepoints)]
    day = F.datediff("ds", F.lit("1970-01-01").cast("date")).cast("double")
    return df.withColumn("x", F.array(
        F.lit(1.0), t, *[F.greatest(t - k, F.lit(0.0)) for k in knots],
        *_waves(day, 365.25, shape.yearly), *_waves(day, 7.0, shape.weekly),
    ))


def _fit_series(shape: Shape):
    """Ridge weights of one series."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(y: pd.Series, x: pd.Series, raw: pd.Series, scale: pd.Series) -> list:
        rows = np.stack([np.asarray(v, dtype=float) for v in x])
        target = y.to_numpy(dtype=float)
        gram, moment = rows.T @ rows, rows.T @ target
        line = np.polyfit(rows[:, 1], target, 1) if len(target) > 2 else [0.0, target.mean()]
        noise = max(float(np.var(target - np.polyval(line, rows[:, 1]))), 1e-12)
        penalty = shape.penalties(noise)
        if shape.sparse:
            coef = _sparse_weights(gram, moment, float(target @ target), shape, noise)
        else:
            coef = solve_normal_equations(gram, moment, float(target @ target), len(target), penalty)[0]
        if shape.capacity is not None:
            coef = _bounded(rows, raw.to_numpy(dtype=float), coef, penalty, shape, float(scale.iloc[0]))
        return coef.tolist()

    return run


def _sparse_weights(gram: np.ndarray, moment: np.ndarray, squares: float, shape: Shape, noise: float) -> np.ndarray:
    """Weights with the changes at the hinges under a penalty on their sizes, the others under a ridge.

    The ridge part has a closed form and is eliminated; what is left is a lasso in
    the hinges only, on cross products. Each change is measured in its own first
    estimate, so that real ones are hardly shrunk and do not call their neighbours
    in. At the default ``changepoint_scale`` a change of its own remains if it is
    beyond sqrt(2 log(n * hinges)) standard errors.
    """
    n, h = float(gram[0, 0]), shape.hinges
    hinges, rest = slice(2, 2 + h), [0, 1, *range(2 + h, shape.width)]
    inner = gram[np.ix_(rest, rest)] + np.diag(shape.penalties(noise)[rest] + 1e-12 * np.trace(gram))
    across = gram[hinges, rest]
    solved = np.linalg.solve(inner, np.column_stack([across.T, moment[rest]]))
    own, pull = gram[hinges, hinges] - across @ solved[:, :-1], moment[hinges] - across @ solved[:, -1]
    first = np.linalg.solve(own + (1e-10 * np.trace(own) + 1e-300) * np.eye(h), pull)
    if n > shape.width:
        noise = max((squares - float(moment[rest] @ solved[:, -1]) - float(first @ pull)) / (n - shape.width), 1e-12)
    weight = 2 * noise * math.log(max(n * h, 2.0)) * 0.05 / shape.changepoint_scale
    change = first * coordinate_descent(own * np.outer(first, first), pull * first, weight, 0.0, np.zeros(h), tolerance=1e-9, sweeps=3000)
    out = np.zeros(shape.width)
    out[hinges], out[rest] = change, solved[:, -1] - solved[:, :-1] @ change
    return out


def _bounded(x: np.ndarray, y: np.ndarray, coef: np.ndarray, penalty: np.ndarray, shape: Shape, scale: float) -> np.ndarray:
    """``_saturating`` from ``coef``; a sparse shape keeps the hinges that ``coef`` has."""
    used = np.ones(len(coef), dtype=bool)
    if shape.sparse:
        used[2 : 2 + shape.hinges] = coef[2 : 2 + shape.hinges] != 0
    out = np.zeros(len(coef))
    out[used] = _saturating(x[:, used], y, coef[used], penalty[used], shape.capacity, scale)
    return out


def _saturating(x: np.ndarray, y: np.ndarray, coef: np.ndarray, penalty: np.ndarray, capacity: float, scale: float, steps: int = 12) -> np.ndarray:
    """Penalised least squares of ``y`` on ``capacity / (1 + exp(-scale x coef))``, by damped Gauss-Newton steps.

    Values of zero, at and above the capacity are fitted as they are.
    """

    def curve(c: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(scale * (x @ c), -40, 40)))

    def cost(c: np.ndarray) -> float:
        return float(np.sum((y / capacity - curve(c)) ** 2) + c @ (penalty * c) / len(y))

    best = cost(coef)
    for _ in range(steps):
        share = curve(coef)
        slope = (scale * share * (1 - share))[:, None] * x
        system = slope.T @ slope + np.diag(penalty / len(y) + 1e-9)
        step = np.linalg.solve(system, slope.T @ (y / capacity - share) - penalty * coef / len(y))
        size = 1.0
        while size > 1e-3 and cost(coef + size * step) > best:
            size /= 2
        if size <= 1e-3:
            break
        coef = coef + size * step
        best = cost(coef)
    return coef


def _link(y: Column, shape: Shape) -> Column:
    if shape.capacity is None:
        return y
    # Only where the fit starts from; the fit itself is on y.
    inside = F.least(F.greatest(y, F.lit(shape.capacity * 1e-3)), F.lit(shape.capacity * (1 - 1e-3)))
    return F.log(inside / (shape.capacity - inside))


def _unlink(value: Column, shape: Shape) -> Column:
    return value if shape.capacity is None else F.lit(shape.capacity) / (1 + F.exp(-value))


def _spans(history: DataFrame, keys: Sequence[str], shape: Shape) -> DataFrame:
    """Per series: first date, length in days and the scale of the values."""
    z = _link(F.col("y"), shape)
    return history.groupBy(*keys).agg(
        F.min("ds").alias("start"), F.greatest(F.datediff(F.max("ds"), F.min("ds")), F.lit(1)).cast("double").alias("span"),
        F.max(F.abs(z)).alias("_top"),
    ).select(*keys, "start", "span", F.when(F.col("_top") > 0, F.col("_top")).otherwise(1.0).alias("scale"))


def _with_rows(df: DataFrame, table: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    if keys:
        return df.join(table.select(*keys, *columns), list(keys))
    packed = df.withColumn("_row", table.select(F.struct(*columns)).scalar())
    return packed.select("*", *[f"_row.{c}" for c in columns]).drop("_row")


def fit(df: DataFrame, shape: Shape, by: Sequence[str] = ()) -> DataFrame:
    """(key..., start, span, scale, coef): one row per series of ``(key..., ds, y)``."""
    history = df.where(F.col("y").isNotNull() & F.col("ds").isNotNull())
    spans = _spans(history, by, shape)
    ready = with_design(_with_rows(history, spans, by, ["start", "span", "scale"]), shape)
    scaled = ready.select(*by, "x", "y", "scale", (_link(F.col("y"), shape) / F.col("scale")).alias("z"))
    coefs = scaled.groupBy(*by).agg(_fit_series(shape)("z", "x", F.col("y").cast("double"), "scale").alias("coef"))
    return _with_rows(coefs, spans, by, ["start", "span", "scale"])


def changes(fitted: DataFrame, shape: Shape, by: Sequence[str] = ()) -> DataFrame:
    """(key..., knot, ds, change): what ``fit`` found at every changepoint; change is in units a day of the (linked) series."""
    if shape.changepoint_dates:
        dates = F.array(*[F.lit(d).cast("date") for d in shape.changepoint_dates])
    else:
        dates = F.transform(
            F.sequence(F.lit(1), F.lit(max(shape.changepoints, 1))),
            lambda i: F.date_add("start", F.round(F.col("span") * shape.changepoint_range * i / max(shape.changepoints, 1)).cast("int")))
    size = F.slice("coef", 3, shape.hinges)
    rows = fitted.select(*by, "scale", "span", dates.alias("_d"), F.posexplode(size).alias("knot", "_c"))
    return rows.select(*by, "knot", F.get("_d", F.col("knot")).alias("ds"), (F.col("_c") * F.col("scale") / F.col("span")).alias("change"))


def _dot(x: Column, coef: Column, first: int, width: int) -> Column:
    parts = F.zip_with(F.slice(x, first + 1, width), F.slice(coef, first + 1, width), lambda a, b: a * b)
    return F.aggregate(parts, F.lit(0.0), lambda s, v: s + v)


def predict(df: DataFrame, fitted: DataFrame, shape: Shape, by: Sequence[str] = ()) -> DataFrame:
    """Add ``yhat`` and the components ``trend``, ``yearly``, ``weekly`` to the dates of ``df``.

    With a capacity the components are on the logit scale.
    """
    rows = with_design(_with_rows(df, fitted, by, ["start", "span", "scale", "coef"]), shape)
    for name, (first, width) in shape.blocks.items():
        value = _dot(F.col("x"), F.col("coef"), first, width) * F.col("scale") if width else F.lit(0.0)
        rows = rows.withColumn(name, value)
    total = F.col("trend") + F.col("yearly") + F.col("weekly")
    return rows.withColumn("yhat", _unlink(total, shape)).drop("start", "span", "scale", "coef", "x")


def residuals(df: DataFrame, predicted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(key..., ds, y, yhat, resid) on the history."""
    keys = [*by, "ds"]
    joined = df.where(F.col("y").isNotNull()).join(predicted.select(*keys, "yhat"), keys)
    return joined.select(*keys, "y", "yhat", (F.col("y") - F.col("yhat")).alias("resid"))


def origins(days: np.ndarray, y: np.ndarray, shapes: Sequence[Shape], horizon: int, initial: int, period: int) -> tuple[np.ndarray, int]:
    """Squared error of every shape, summed over all cutoffs of one series, and how many held-out values there were.

    ``days`` rise. The cross products of level, time, waves and values are summed
    along the dates once: what a cutoff is fitted from is a prefix, and so is what
    lies behind a changepoint, so the products of its hinges are differences of
    prefixes. The shapes differ in their penalties only.
    """
    shape = shapes[0]
    errors = np.zeros(len(shapes))
    room = int(days[-1] - days[0]) - horizon - initial if len(days) else -1
    if room < 0:
        return errors, 0
    time = (days - days[0]).astype(float)
    waves = _wave_table(days, shape)
    z = _link_values(y, shape)
    rows = np.column_stack([np.ones(len(time)), time, waves, z])
    sums = np.concatenate([np.zeros((1, rows.shape[1], rows.shape[1])), np.cumsum(rows[:, :, None] * rows[:, None, :], axis=0)])
    top = np.maximum.accumulate(np.abs(z))
    given = np.array([np.datetime64(d, "D").astype(int) - days[0] for d in shape.changepoint_dates], dtype=float)
    hinges, width, tested = shape.hinges, shape.width, 0
    still = [0, 1, *range(2 + hinges, width)]
    for cut in range(int(days[-1]) - horizon, int(days[0]) + initial - 1, -period):
        n, end = np.searchsorted(days, [cut, cut + horizon], side="right")
        if n == end:
            continue
        span, scale = max(time[n - 1], 1.0), top[n - 1] or 1.0
        knots = given if len(given) else span * shape.changepoint_range * np.arange(1, hinges + 1) / hinges
        total = sums[n]
        behind = total - sums[np.minimum(np.searchsorted(time, knots, side="right"), n)]
        gram, moment = np.zeros((width, width)), np.zeros(width)
        gram[np.ix_(still, still)] = total[:-1, :-1]
        moment[still] = total[:-1, -1]
        if hinges:
            across = behind[:, 1] - knots[:, None] * behind[:, 0]
            gram[2 : 2 + hinges, still], gram[np.ix_(still, range(2, 2 + hinges))] = across[:, :-1], across[:, :-1].T
            moment[2 : 2 + hinges] = across[:, -1]
            later = np.maximum.outer(np.arange(hinges), np.arange(hinges)) if not len(given) else np.where(knots[:, None] >= knots, np.arange(hinges)[:, None], np.arange(hinges))
            last = behind[later]
            gram[2 : 2 + hinges, 2 : 2 + hinges] = last[..., 1, 1] - np.add.outer(knots, knots) * last[..., 0, 1] + np.multiply.outer(knots, knots) * last[..., 0, 0]
        unit = np.r_[1.0, np.full(1 + hinges, 1 / span), np.ones(width - 2 - hinges)]
        gram, moment = gram * np.outer(unit, unit), moment * unit / scale
        spread, drift = total[1, 1] - total[0, 1] ** 2 / n, total[1, -1] - total[0, 1] * total[0, -1] / n
        rest = total[-1, -1] - total[0, -1] ** 2 / n - (drift**2 / spread if n > 2 and spread > 0 else 0.0)
        noise = max(float(rest) / n / scale**2, 1e-12)
        design = lambda at: np.column_stack([
            np.ones(len(time[at])), time[at] / span, np.maximum(time[at][:, None] - knots, 0.0) / span, waves[at]])  # noqa: B023
        penalties = np.stack([s.penalties(noise) for s in shapes])
        if shape.sparse:
            coefs = np.stack([_sparse_weights(gram, moment, float(total[-1, -1]) / scale**2, s, noise) for s in shapes])
        else:
            coefs = np.linalg.solve(gram + penalties[:, None, :] * np.eye(width), np.broadcast_to(moment, (len(shapes), width))[..., None])[..., 0]
        if shape.capacity is not None:
            known = design(slice(0, n))
            coefs = np.stack([_bounded(known, y[:n], c, p, shape, float(scale)) for c, p in zip(coefs, penalties)])
        said = design(slice(n, end)) @ coefs.T * scale
        if shape.capacity is not None:
            said = shape.capacity / (1 + np.exp(-said))
        errors += ((y[n:end, None] - said) ** 2).sum(axis=0)
        tested += int(end - n)
    return errors, tested


def _wave_table(days: np.ndarray, shape: Shape) -> np.ndarray:
    angles = [2 * math.pi * k * days / period for period, order in ((365.25, shape.yearly), (7.0, shape.weekly)) for k in range(1, order + 1)]
    return np.column_stack([f(a) for a in angles for f in (np.sin, np.cos)]) if angles else np.zeros((len(days), 0))


def _link_values(y: np.ndarray, shape: Shape) -> np.ndarray:
    if shape.capacity is None:
        return y
    inside = np.clip(y, shape.capacity * 1e-3, shape.capacity * (1 - 1e-3))
    return np.log(inside / (shape.capacity - inside))


def rolling_origin(
    df: DataFrame, shape: Shape, grid: Sequence[tuple[float, float]], horizon_days: int = 30, initial_days: int | None = None,
    period_days: int | None = None, by: Sequence[str] = (),
) -> DataFrame:
    """(changepoint_scale, season_scale, rmse, n) over every cutoff of every series.

    Cutoffs go back from the last date less the horizon in steps of ``period_days``
    (half a horizon) as long as ``initial_days`` (three horizons) are left. A row is
    read once, however many cutoffs and settings there are; a series is one row of
    arrays, bounded by its calendar, and series spread over tasks. Series too short
    for a cutoff add nothing.
    """
    shapes = [replace(shape, changepoint_scale=c, season_scale=s) for c, s in grid]
    initial = 3 * horizon_days if initial_days is None else initial_days
    period = max(1, horizon_days // 2) if period_days is None else period_days

    @F.pandas_udf("array<double>")
    def run(days: pd.Series, ys: pd.Series) -> pd.Series:
        out = []
        for d, y in zip(days, ys):
            errors, n = origins(np.asarray(d, dtype=int), np.asarray(y, dtype=float), shapes, horizon_days, initial, period)
            out.append([*errors.tolist(), float(n)])
        return pd.Series(out)

    day = F.datediff("ds", F.lit("1970-01-01").cast("date"))
    points = F.array_sort(F.collect_list(F.struct(day.alias("day"), F.col("y").cast("double").alias("y"))))
    packed = df.where(F.col("y").isNotNull() & F.col("ds").isNotNull()).groupBy(*by).agg(points.alias("t"))
    errors = packed.select(run(F.col("t.day"), F.col("t.y")).alias("e"))
    totals = errors.select(F.posexplode("e").alias("setting", "sq")).groupBy("setting").agg(F.sum("sq").alias("sq"))
    n = totals.where(F.col("setting") == len(grid)).select(F.col("sq").alias("n"))
    names = F.array(*[F.struct(F.lit(float(c)).alias("c"), F.lit(float(s)).alias("s")) for c, s in grid])
    setting = F.get(names, F.col("setting"))
    table = totals.where(F.col("setting") < len(grid)).withColumn("n", n.scalar())
    return table.select(
        setting["c"].alias("changepoint_scale"), setting["s"].alias("season_scale"), F.sqrt(F.try_divide("sq", "n")).alias("rmse"), F.col("n").cast("long").alias("n"))
