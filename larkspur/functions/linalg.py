"""Least squares per group from sums of cross products.

The sums are ordinary Spark aggregates: partial sums are merged map-side, so a
key that owns a third of all rows costs no more than any other. Only the k x k
system per key is solved with numpy, on one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIT_SCHEMA = T.StructType([
    T.StructField("coef", T.ArrayType(T.DoubleType())),
    T.StructField("stderr", T.ArrayType(T.DoubleType())),
    T.StructField("sse", T.DoubleType()),
    T.StructField("rank", T.IntegerType()),
])


def solve_normal_equations(gram: np.ndarray, moment: np.ndarray, yy: float, n: float, penalty: np.ndarray | None = None):
    """Coefficients, standard errors, residual sum of squares and rank."""
    k = len(moment)
    system = gram + np.diag(penalty) if penalty is not None else gram
    scale = np.sqrt(np.clip(np.diag(system), 1e-300, None))
    inverse = np.linalg.pinv(system / np.outer(scale, scale), rcond=1e-12, hermitian=True)
    coef = (inverse @ (moment / scale)) / scale
    sse = max(yy - 2 * coef @ moment + coef @ gram @ coef, 0.0)
    rank = int(np.linalg.matrix_rank(system / np.outer(scale, scale), tol=1e-10, hermitian=True))
    variance = sse / (n - rank) if n > rank else float("nan")
    stderr = np.sqrt(np.clip(variance * np.diag(inverse), 0, None)) / scale
    return coef, stderr, sse, rank


@F.pandas_udf(FIT_SCHEMA)
def _solve(gram: pd.Series, moment: pd.Series, yy: pd.Series, n: pd.Series, means: pd.Series, mean_y: pd.Series) -> pd.DataFrame:
    """Solve one system per row. With ``means`` the products are centred and an intercept is put in front."""
    rows = []
    for g, m, y2, count, centre, level in zip(gram, moment, yy, n, means, mean_y):
        m = np.asarray(m, dtype=float)
        k = len(m)
        full = np.zeros((k, k))
        full[np.triu_indices(k)] = np.asarray(g, dtype=float)
        full = full + np.triu(full, 1).T
        if centre is None:
            coef, stderr, sse, rank = solve_normal_equations(full, m, y2, count)
        else:
            coef, stderr, sse, rank = with_intercept(full, m, y2, count, np.asarray(centre, dtype=float), level)
        rows.append((coef.tolist(), [None if np.isnan(s) else float(s) for s in stderr], float(sse), rank))
    return pd.DataFrame(rows, columns=["coef", "stderr", "sse", "rank"])


def with_intercept(gram: np.ndarray, moment: np.ndarray, yy: float, n: float, centre: np.ndarray, level: float):
    """``solve_normal_equations`` on centred products, with the intercept and its error from the means."""
    k = len(moment)
    scale = np.sqrt(np.clip(np.diag(gram), 1e-300, None))
    inverse = np.linalg.pinv(gram / np.outer(scale, scale), rcond=1e-12, hermitian=True) / np.outer(scale, scale) if k else gram
    slopes = inverse @ moment
    sse = max(yy - slopes @ moment, 0.0)
    rank = 1 + (int(np.linalg.matrix_rank(gram / np.outer(scale, scale), tol=1e-10, hermitian=True)) if k else 0)
    variance = sse / (n - rank) if n > rank else float("nan")
    spread = np.concatenate([[1 / n + centre @ inverse @ centre], np.diag(inverse)])
    return np.concatenate([[level - slopes @ centre], slopes]), np.sqrt(np.clip(variance * spread, 0, None)), sse, rank


def grouped_ols(
    df: DataFrame,
    target: str,
    features: Sequence[str],
    by: Sequence[str] = (),
    intercept: bool = True,
) -> DataFrame:
    """One row per key: ``coef`` (intercept first), ``stderr``, ``sse``, ``n``, ``r2``, ``sigma2``, ``aic``.

    Rows with a null in any used column are left out. The system is scaled to
    unit diagonal before it is solved.
    """
    used = df.dropna(subset=[target, *features, *by])
    return ols_of_terms(used, F.col(target), [F.col(f) for f in features], by, intercept)


def ols_of_terms(
    df: DataFrame, target: Column, features: Sequence[Column], by: Sequence[str] = (), intercept: bool = True
) -> DataFrame:
    """``grouped_ols`` on expressions without nulls.

    The expressions go straight into the sums: as separate columns below a
    filter, many of them make the optimizer's search for constraints slow.
    """
    y = target.cast("double")
    terms: list[Column] = [f.cast("double") for f in features]
    pairs = [(i, j) for i in range(len(terms)) for j in range(i, len(terms))]
    n = F.count(F.lit(1))
    if intercept:
        # Products around the means, merged map-side: a large mean costs no digits.
        sums = [
            F.array(*[F.covar_pop(terms[i], terms[j]) * n for i, j in pairs]).cast("array<double>").alias("_gram"),
            F.array(*[F.covar_pop(t, y) * n for t in terms]).cast("array<double>").alias("_moment"),
            (F.var_pop(y) * n).alias("_yy"),
            F.array(*[F.avg(t) for t in terms]).cast("array<double>").alias("_means"), F.avg(y).alias("_level"),
        ]
    else:
        sums = [
            F.array(*[F.sum(terms[i] * terms[j]) for i, j in pairs]).alias("_gram"),
            F.array(*[F.sum(t * y) for t in terms]).alias("_moment"), F.sum(y * y).alias("_yy"),
            F.lit(None).cast("array<double>").alias("_means"), F.lit(0.0).alias("_level"),
        ]
    sums = df.groupBy(*by).agg(*sums, n.alias("n")).where("n > 0")
    fitted = sums.withColumn("_fit", _solve("_gram", "_moment", "_yy", F.col("n").cast("double"), "_means", "_level"))
    total = F.col("_yy")
    k = F.col("_fit.rank")
    return fitted.select(
        *by,
        "n",
        F.col("_fit.coef").alias("coef"),
        F.col("_fit.stderr").alias("stderr"),
        F.col("_fit.sse").alias("sse"),
        k.alias("rank"),
        (1 - F.col("_fit.sse") / F.when(total != 0, total)).alias("r2"),
        (F.col("_fit.sse") / F.when(F.col("n") > k, F.col("n") - k)).alias("sigma2"),
        gaussian_aic(F.col("_fit.sse"), F.col("n"), k + 1).alias("aic"),
    )


def gaussian_aic(sse: Column, n: Column, n_params: Column) -> Column:
    """AIC of a Gaussian regression; the error variance counts as a parameter."""
    mean_square = F.greatest(sse / n, F.lit(1e-300))
    return n * (F.log(F.lit(2 * np.pi)) + F.log(mean_square) + 1) + 2 * n_params


def linear_score(coef: Column, features: Sequence[str], intercept: bool = True) -> Column:
    """Dot product of a coefficient array with feature columns."""
    first = 1 if intercept else 0
    out = coef[0] if intercept else F.lit(0.0)
    for i, name in enumerate(features):
        out = out + coef[i + first] * F.col(name)
    return out
