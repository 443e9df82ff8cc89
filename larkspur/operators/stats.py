"""Tests, fit measures and error metrics, each from one aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.distributions import normal_cdf, t_p_value, t_quantile
from larkspur.functions.gram import cross_products, gather
from larkspur.operators.aggregates import correlation_matrix


def error_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """mse, rmse and r2 over rows where both are present."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    sums = df.where(y.isNotNull() & p.isNotNull()).agg(
        F.avg((y - p) * (y - p)).alias("mse"), F.var_pop(y).alias("_var")
    )
    r2 = 1 - F.col("mse") / F.when(F.col("_var") != 0, F.col("_var"))
    return sums.select("mse", F.sqrt("mse").alias("rmse"), r2.alias("r2"))


def error_ratio(df: DataFrame, actual: str, predicted: str, threshold: float) -> DataFrame:
    """rmse over the standard deviation of the target, and whether it is below ``threshold``."""
    y, p = F.col(actual), F.col(predicted)
    sums = df.agg(F.avg((y - p) * (y - p)).alias("_mse"), F.stddev_samp(y).alias("_std"))
    ratio = F.sqrt("_mse") / F.when(F.col("_std") != 0, F.col("_std"))
    return sums.select(ratio.alias("ratio"), (ratio < threshold).alias("under_threshold"))


def linear_formula(intercept: float, weights: Mapping[str, float]) -> Column:
    """A score from known coefficients."""
    out = F.lit(float(intercept))
    for name, weight in weights.items():
        out = out + F.lit(float(weight)) * F.col(name)
    return out


def share_below(df: DataFrame, column: str, value: float | Column) -> DataFrame:
    """Normal approximation of the share of rows below ``value``; null where the column does not vary."""
    row = df.agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"))
    value = value if isinstance(value, Column) else F.lit(float(value))
    z = F.try_divide(value - F.col("mean"), F.col("std"))
    return row.select("mean", "std", z.alias("z")).withColumn("share", normal_cdf("z"))


def welch_test(df: DataFrame, group: str, column: str, first, second, level: float = 0.95) -> DataFrame:
    """Two-sample t-test with unequal variances: t, df, p-value and interval of the mean difference.

    Where neither group varies, or one has fewer than two values, the test is null.
    """
    x = F.col(column).cast("double")
    one, two = F.when(F.col(group) == F.lit(first), x), F.when(F.col(group) == F.lit(second), x)
    row = df.agg(
        F.avg(one).alias("mean_first"), F.avg(two).alias("mean_second"),
        F.try_divide(F.var_samp(one), F.count(one)).alias("_a"), F.try_divide(F.var_samp(two), F.count(two)).alias("_b"),
        F.count(one).alias("_n"), F.count(two).alias("_m"),
    )
    a, b = F.col("_a"), F.col("_b")
    error = F.sqrt(a + b)
    freedom = F.try_divide((a + b) * (a + b), F.try_divide(a * a, F.col("_n") - 1) + F.try_divide(b * b, F.col("_m") - 1))
    gap = F.col("mean_first") - F.col("mean_second")
    tested = row.select("mean_first", "mean_second", gap.alias("_gap"), error.alias("_error"), F.try_divide(gap, error).alias("t"), freedom.alias("df"))
    half = t_quantile(float(level), F.col("df")) * F.col("_error")
    return tested.withColumn("p_value", t_p_value("t", "df")).withColumn("_half", half).select(
        "mean_first", "mean_second", "t", "df", "p_value",
        (F.col("_gap") - F.col("_half")).alias("ci_low"), (F.col("_gap") + F.col("_half")).alias("ci_high"),
    )


def variance_inflation(df: DataFrame, predictors: Sequence[str]) -> DataFrame:
    """Variance inflation factor per predictor: the diagonal of the inverse correlation matrix."""
    k = len(predictors)
    cells = correlation_matrix(df, predictors).collect()  # k x k numbers
    matrix = np.zeros((k, k))
    for cell in cells:
        matrix[cell.i, cell.j] = cell.corr
    factors = np.diag(np.linalg.inv(matrix))
    return df.sparkSession.createDataFrame(
        [(name, float(v)) for name, v in zip(predictors, factors)], "predictor string, vif double"
    )


def generalised_inflation(df: DataFrame, terms: Mapping[str, Sequence[str]], weight: Column | None = None) -> DataFrame:
    """Inflation of each term of a model with an intercept: (term, df, gvif, gvif_scaled).

    A term is one numeric column or the 0/1 columns of a factor (without its first
    level). ``weight`` is what a row adds to the information matrix, p (1 - p) for
    a logit; without it the model is linear. The factor is det(own block) *
    det(block of the others) / det(all), and ``gvif_scaled`` its 2 df-th root,
    which compares terms of different width. Rows with a null anywhere are left
    out. Where a term is a sum of others, or does not vary, factors are null.
    Only columns squared numbers reach the driver.
    """
    columns = list(dict.fromkeys(c for group in terms.values() for c in group))
    weight = F.lit(1.0) if weight is None else weight.cast("double")
    used = df.select(weight.alias("_w"), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)]).dropna()
    names = [f"_x{i}" for i in range(len(columns))]
    # About the weighted means first: sums about zero would lose digits.
    means = used.agg(*[F.try_divide(F.sum(F.col(c) * F.col("_w")), F.sum("_w")).alias(c) for c in names]).first()
    schema = "term string, df int, gvif double, gvif_scaled double"
    if not columns or means[0] is None:
        return df.sparkSession.createDataFrame([], schema)
    scaled = used.select(*[((F.col(c) - means[c]) * F.sqrt("_w")).alias(c) for c in names], F.sqrt("_w").alias("_w"))
    p = gather(cross_products(scaled, [*names, "_w"]))[()]
    full = p.gram + p.n * np.outer(p.mean, p.mean)
    matrix = full[:-1, :-1] - np.outer(full[:-1, -1], full[-1, :-1]) / full[-1, -1]
    spread = np.sqrt(np.clip(np.diag(matrix), 0, None))
    unit = np.where(spread > 0, 1 / np.where(spread > 0, spread, 1), 0.0)
    matrix = matrix * np.outer(unit, unit)

    def log_det(at: Sequence[int]) -> float:
        sign, value = np.linalg.slogdet(matrix[np.ix_(at, at)]) if len(at) else (1.0, 0.0)
        return float(value) if sign > 0 and value > -27.0 * max(len(at), 1) else float("nan")

    rows, everything = [], log_det(range(len(columns)))
    for term, group in terms.items():
        own = [columns.index(c) for c in dict.fromkeys(group)]
        rest = [i for i in range(len(columns)) if i not in own]
        log = log_det(own) + log_det(rest) - everything
        known = not np.isnan(log)
        rows.append((term, len(own), float(np.exp(log)) if known else None, float(np.exp(log / (2 * len(own)))) if known else None))
    return df.sparkSession.createDataFrame(rows, schema)


def logit_fit_measures(df: DataFrame, label: str, probability: str, rank: int) -> DataFrame:
    """Fit measures of a logit model from labels and fitted probabilities.

    ``rank`` is the number of estimated coefficients, intercept included. All
    ten measures come from one aggregate over (label, probability).
    """
    y, p = F.col(label).cast("double"), F.col(probability).cast("double")
    eta = F.log(p / (1 - p))
    hit = (p > 0.5).cast("double") == y
    row = df.where(y.isNotNull() & p.isNotNull()).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.avg(y).alias("base"),
        F.sum(F.when(y == 1, F.log(p)).otherwise(F.log(1 - p))).alias("ll"),
        (F.var_pop(eta) * F.count(F.lit(1))).alias("spread"),
        F.sum((y - p) * (y - p)).alias("residual"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("total"),
        F.count_if(hit).cast("double").alias("hits"),
        F.greatest(F.sum(y), F.sum(1 - y)).alias("majority"),
    )
    n, base = F.col("n"), F.col("base")
    null_ll = n * (
        F.when(base > 0, base * F.log(base)).otherwise(0.0)
        + F.when(base < 1, (1 - base) * F.log(1 - base)).otherwise(0.0)
    )
    row = row.withColumn("ll0", null_ll)
    ll, ll0 = F.col("ll"), F.col("ll0")
    latent_variance = float(np.pi**2 / 3)
    cox_snell = 1 - F.exp(2 * (ll0 - ll) / n)
    aic = 2 * F.lit(rank) - 2 * ll
    return row.select(
        (1 - ll / ll0).alias("mcfadden"),
        (1 - (ll - rank - 1) / ll0).alias("mcfadden_adjusted"),
        cox_snell.alias("cox_snell"),
        (cox_snell / (1 - F.exp(2 * ll0 / n))).alias("nagelkerke"),
        (F.col("spread") / (n * latent_variance + F.col("spread"))).alias("mckelvey_zavoina"),
        (1 - F.col("residual") / F.col("total")).alias("efron"),
        (F.col("hits") / n).alias("count_r2"),
        ((F.col("hits") - F.col("majority")) / F.when(n != F.col("majority"), n - F.col("majority"))).alias("count_adjusted"),
        aic.alias("aic"),
        (aic + 2 * rank * (rank + 1) / (n - rank - 1)).alias("aic_corrected"),
    )


def class_report(df: DataFrame, predicted: str, actual: str, classes: Sequence) -> DataFrame:
    """Accuracy, and precision, recall and F per class.

    Precision divides by the predicted size of the class, recall by its actual size.
    """
    p, a = F.col(predicted), F.col(actual)
    row = df.where(p.isNotNull() & a.isNotNull()).agg(
        (F.count_if(p == a) / F.count(F.lit(1))).alias("accuracy"),
        F.array(*[F.struct(
            F.lit(c).alias("class"),
            F.count_if((p == F.lit(c)) & (a == F.lit(c))).alias("hit"),
            F.count_if(p == F.lit(c)).alias("said"),
            F.count_if(a == F.lit(c)).alias("is"),
        ) for c in classes]).alias("cells"),
    )
    cells = row.select("accuracy", F.explode("cells").alias("c")).select("accuracy", "c.*")
    precision = F.col("hit") / F.when(F.col("said") > 0, F.col("said"))
    recall = F.col("hit") / F.when(F.col("is") > 0, F.col("is"))
    total = precision + recall
    return cells.select(
        "class", "accuracy", precision.alias("precision"), recall.alias("recall"),
        (2 * precision * recall / F.when(total > 0, total)).alias("f_score"),
    )
