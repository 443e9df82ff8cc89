"""Filling missing values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larkspur.functions.linalg import grouped_ols, linear_score
from larkspur.functions.text import blank_to
from larkspur.operators.quantiles import exact_quantiles


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing marker: NaN becomes null in every fractional column."""
    return df.withColumns({
        name: F.when(~F.isnan(F.col(f"`{name}`")), F.col(f"`{name}`"))
        for name, kind in df.dtypes if kind in ("double", "float")
    })


def fill_constant(df: DataFrame, values: Mapping) -> DataFrame:
    return df.fillna(dict(values))


def fill_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    means = df.select(F.struct(*[F.avg(c).alias(c) for c in columns])).scalar()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), means[c]) for c in columns})


def fill_mode(df: DataFrame, column: str) -> DataFrame:
    """Most frequent value, the smallest among equals; counted by a grouped aggregate, not in one buffer."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.orderBy(F.col("_n").desc(), F.col(column).asc()).limit(1).select(column).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), best))


def fill_blank(df: DataFrame, columns: Sequence[str], replacement: str = "N/A") -> DataFrame:
    return df.withColumns({c: blank_to(F.col(c), replacement) for c in columns})


def fill_from_lookup(
    df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, values: Sequence[str], prefix_length: int = 4
) -> DataFrame:
    """Left-join ``values`` from a lookup; where the key is unknown use its prefix group's median.

    The medians use lookup rows that are complete in all value columns.
    """
    known = lookup.select(F.col(lookup_key).alias("_key"), *[F.col(v).cast("double").alias(v) for v in values])
    complete = known.dropna(subset=list(values)).withColumn("_prefix", F.substring("_key", 1, prefix_length))
    long = exact_quantiles(complete, values, [0.5], ["_prefix"])
    medians = long.groupBy("_prefix").agg(*[
        F.max(F.when(F.col("column") == v, F.col("value"))).alias(f"_median_{v}") for v in values
    ])
    direct = df.join(known, F.col(key) == F.col("_key"), "left").withColumn(
        "_prefix", F.substring(key, 1, prefix_length)
    )
    filled = direct.join(medians, "_prefix", "left")
    return filled.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[F.coalesce(F.col(v), F.col(f"_median_{v}")).alias(v) for v in values],
    )


def fill_by_regression(df: DataFrame, targets: Sequence[str], predictors: Sequence[str]) -> DataFrame:
    """Fill each target's gaps with a linear regression fitted on its complete rows."""
    out = df
    for target in targets:
        fit = grouped_ols(df, target, predictors).select("coef").scalar()
        out = out.withColumn(target, F.coalesce(F.col(target).cast("double"), linear_score(fit, predictors)))
    return out


def fill_by_simple_regression(df: DataFrame, target: str, predictor: str) -> DataFrame:
    """One predictor, closed form."""
    line = df.select(F.struct(
        F.regr_slope(target, predictor).alias("slope"), F.regr_intercept(target, predictor).alias("intercept")
    )).scalar()
    return df.withColumn(
        target, F.coalesce(F.col(target).cast("double"), line["intercept"] + line["slope"] * F.col(predictor))
    )


def fill_neighbour_mean(df: DataFrame, column: str, order: str, by: Sequence[str] = ()) -> DataFrame:
    """Fill a gap with the mean of the value before it (repaired) and the next raw value.

    In a run of gaps every repaired value equals the one before it as long as
    the next raw value is missing, so the repaired predecessor is the last known
    value. Meant for series of at most one row per key and calendar day.
    """
    ordered = W.partitionBy(*by).orderBy(order)
    before = F.last(column, ignorenulls=True).over(ordered.rowsBetween(W.unboundedPreceding, -1))
    after = F.lead(column).over(ordered)
    filled = F.coalesce((before + after) / 2, before, after)
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), filled))
