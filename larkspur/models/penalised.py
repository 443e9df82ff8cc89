"""Lasso and elastic net from cross products: one scan for all folds and penalties."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.gram import Products, cross_products, gather


def coordinate_descent(
    gram: np.ndarray, moment: np.ndarray, l1: float, l2: float, start: np.ndarray, tolerance: float = 1e-12, sweeps: int = 10_000
) -> np.ndarray:
    """Minimise u'Gu/2 - m'u + l1 |u| + l2/2 u², from ``start``.

    Coordinates that are not zero are swept until they rest; then all others are
    looked at together, and those that may move join in.
    """
    u, own = start.copy(), np.diag(gram)
    rest = moment - gram @ u
    active = np.flatnonzero(u)
    limit = tolerance * max(1.0, float(np.abs(moment).max(initial=0.0)))
    for _ in range(sweeps):
        moved = 0.0
        for j in active:
            if own[j] <= 0:
                continue
            pull = rest[j] + own[j] * u[j]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / (own[j] + l2)
            step = new - u[j]
            if step:
                rest -= gram[:, j] * step
                u[j] = new
                moved = max(moved, abs(step) * own[j])
        if moved <= limit:
            idle = (u == 0) & (np.abs(rest) > l1 + limit) & (own > 0)
            if not idle.any():
                break
            active = np.flatnonzero((u != 0) | idle)
    return u


def _standardised(p: Products) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gram matrix and moments of the features (all but the last column) over the row count, in units of their (population) deviations."""
    spread = np.sqrt(np.clip(np.diag(p.gram)[:-1], 0, None) / p.n)
    unit = np.where(spread > 0, 1 / np.where(spread > 0, spread, 1), 0.0)
    return p.gram[:-1, :-1] * np.outer(unit, unit) / p.n, p.gram[:-1, -1] * unit / p.n, unit


def penalty_path(p: Products, penalties: Sequence[float], mixing: float = 1.0) -> list[tuple[float, np.ndarray, float]]:
    """(penalty, coefficients, intercept) for falling penalties, each fit from the one before. The target is the last column.

    As in Spark's linear regression, features and target are measured in their
    deviations: the squared part of the penalty is divided by the target's.
    """
    if p.n < 1:
        k = len(p.mean) - 1
        return [(x, np.zeros(k), 0.0) for x in sorted(penalties, reverse=True)]
    gram, moment, unit = _standardised(p)
    level = float(np.sqrt(p.gram[-1, -1] / p.n)) or 1.0
    u, out = np.zeros(len(moment)), []
    for penalty in sorted(penalties, reverse=True):
        u = coordinate_descent(gram, moment, penalty * mixing, penalty * (1 - mixing) / level, u)
        weights = u * unit
        out.append((float(penalty), weights, float(p.mean[-1] - weights @ p.mean[:-1])))
    return out


def squared_error(p: Products, weights: np.ndarray, intercept: float) -> float:
    """Mean squared error over the rows of ``p``."""
    aim = np.r_[-weights, 1.0]
    off = p.mean[-1] - weights @ p.mean[:-1] - intercept
    return float(max(aim @ p.gram @ aim, 0.0) / p.n + off * off)


def penalties_from(p: Products, count: int = 100, least: float = 1e-3, mixing: float = 1.0) -> list[float]:
    """``count`` penalties in equal ratios, from the least one that leaves no feature down to ``least`` times that."""
    _, moment, _ = _standardised(p)
    top = float(np.abs(moment).max(initial=0.0)) / mixing
    return [0.0] if top == 0 else np.geomspace(top, top * least, count).tolist()


@dataclass(frozen=True)
class PenalisedFit:
    """The fit with the chosen penalty; ``errors`` has (fold, penalty, mse) of every held-out fold."""

    names: list[str]
    coefficients: list[float]
    intercept: float
    penalty: float
    errors: DataFrame | None

    def score(self) -> Column:
        """The prediction as a column."""
        weighted = F.zip_with(F.array(*[F.col(n).cast("double") for n in self.names]), F.array(*map(F.lit, self.coefficients)), lambda x, w: x * w)
        return F.aggregate(weighted, F.lit(self.intercept), lambda a, v: a + v)


def elastic_net_fit(df: DataFrame, target: str, features: Sequence[str], penalty: float, mixing: float = 0.5) -> PenalisedFit:
    """Elastic net on standardised features, to convergence; ``penalty_path`` tells what is minimised."""
    found = gather(cross_products(df, [*features, target]))
    if not found:
        return PenalisedFit(list(features), [0.0] * len(features), 0.0, penalty, None)
    (_, weights, intercept), = penalty_path(found[()], [penalty], mixing)
    return PenalisedFit(list(features), weights.tolist(), intercept, penalty, None)


def lasso_by_folds(
    df: DataFrame, target: str, features: Sequence[str], fold: Column, penalties: Sequence[float] | None = None, count: int = 100, mixing: float = 1.0
) -> PenalisedFit:
    """Lasso whose penalty has the least mean squared error over held-out folds.

    One scan makes the cross products of every fold; what a fold is trained on is
    the total less the fold. Every fold's whole path of penalties is a task of its
    own, on (features + 1)² numbers a fold, which is all that is broadcast. Without
    ``penalties`` there are ``count`` of them in equal ratios down from the one that
    leaves no feature; of equal errors the larger penalty is taken. Rows with a null
    fold, feature or target are left out; without rows all coefficients are 0.
    """
    names = list(features)
    spark = df.sparkSession
    blocks = cross_products(df.withColumn("_fold", fold).where("_fold IS NOT NULL"), [*names, target], ["_fold"])
    parts = {key[0]: p for key, p in gather(blocks, ["_fold"]).items()}
    if not parts:
        return PenalisedFit(names, [0.0] * len(names), 0.0, 0.0, None)
    folds = sorted(parts)
    total = sum((parts[f] for f in folds[1:]), parts[folds[0]])
    tried = list(penalties) if penalties is not None else penalties_from(total, count, mixing=mixing)
    shared = spark.sparkContext.broadcast((total, [parts[f] for f in folds]))

    def paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole, held = shared.value
        for batch in batches:
            for at in batch["id"]:
                path = penalty_path(whole - held[at], tried, mixing)
                yield pd.DataFrame([(at, p, squared_error(held[at], w, b)) for p, w, b in path], columns=["place", "penalty", "mse"])

    found = spark.range(0, len(folds), 1, len(folds)).mapInPandas(paths, "place long, penalty double, mse double").toPandas()
    mean = found.groupby("penalty")["mse"].mean()
    best = float(max(mean.index[mean <= mean.min()]))
    _, weights, intercept = penalty_path(total, [p for p in tried if p >= best], mixing)[-1]
    kind = blocks.schema["_fold"].dataType
    errors = spark.createDataFrame(
        [(folds[int(r.place)], float(r.penalty), float(r.mse)) for r in found.itertuples()], f"fold {kind.simpleString()}, penalty double, mse double")
    return PenalisedFit(names, weights.tolist(), intercept, best, errors)
