"""Series preparation and simple window steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larkspur.operators.aggregates import correlation
from larkspur.functions.dates import drop_zone, to_day
from larkspur.operators.calendar import resample
from larkspur.session import checkpointed


def prepare(df: DataFrame, date: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(key..., ds, y): wall-clock day and the day's mean value."""
    picked = df.select(*by, to_day(drop_zone(F.col(date))).alias("ds"), F.col(value).cast("double").alias("y"))
    return picked.groupBy(*by, "ds").agg(F.avg("y").alias("y"))


def regular(df: DataFrame, date: str, value: str, period: str, by: Sequence[str] = (), how: str = "sum") -> DataFrame:
    """(key..., ds, y) on a dense calendar.

    Checkpointed: the models read a series several times, the raw rows should be read once.
    """
    args = {"sums": [value]} if how == "sum" else {"means": [value]}
    out = resample(df, date, period, by=by, label="ds", **args)
    return checkpointed(out.select(*by, "ds", F.col(f"{how}_{value}").cast("double").alias("y")))


def ordered(by: Sequence[str] = (), ds: str = "ds"):
    return W.partitionBy(*by).orderBy(ds)


def running_count(df: DataFrame, category: str, date: str) -> DataFrame:
    """Running number of rows per category in date order."""
    daily = df.groupBy(category, F.col(date).cast("date").alias(date)).agg(F.count(F.lit(1)).alias("count"))
    upto = ordered([category], date).rowsBetween(W.unboundedPreceding, 0)
    return daily.withColumn("running", F.sum("count").over(upto))


def difference(df: DataFrame, column: str = "y", lag: int = 1, by: Sequence[str] = (), name: str | None = None) -> DataFrame:
    """``y - y[lag steps before]``."""
    return df.withColumn(name or column, F.col(column) - F.lag(column, lag).over(ordered(by)))


def differences(df: DataFrame, column: str, d: int, seasonal_d: int, season: int, by: Sequence[str], name: str) -> DataFrame:
    """d first differences and ``seasonal_d`` seasonal ones."""
    out = df.withColumn(name, F.col(column).cast("double"))
    for lag in [1] * d + [season] * seasonal_d:
        out = difference(out, name, lag, by)
    return out


def neighbours(df: DataFrame, column: str = "y", by: Sequence[str] = ()) -> DataFrame:
    w = ordered(by)
    return df.withColumns({"before": F.lag(column).over(w), "after": F.lead(column).over(w)})


def paired_correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    """Correlation of two aligned series: of their levels and of their first differences; null without spread."""
    w = ordered()
    steps = df.select(a, b, (F.col(a) - F.lag(a).over(w)).alias("_da"), (F.col(b) - F.lag(b).over(w)).alias("_db"))
    return steps.agg(correlation(a, b).alias("levels"), correlation("_da", "_db").alias("differences"))


