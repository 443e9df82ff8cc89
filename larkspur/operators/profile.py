"""Profiles of a table: sizes, types, nulls, distinct values, numeric summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.columns import numeric_names
from larkspur.operators.quantiles import exact_quantiles
from larkspur.operators.rows import any_null


def _entries(names: Sequence[str], *aggregates) -> Column:
    """An array of (column, aggregate...) structs, to be exploded after one aggregation."""
    return F.array(*[F.struct(F.lit(n).alias("column"), *[a(n) for a in aggregates]) for n in names])


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def column_info(df: DataFrame) -> DataFrame:
    """(position, column, type, non_null) from one pass."""
    kinds = dict(df.dtypes)
    places = {n: i for i, n in enumerate(df.columns)}
    packed = df.agg(_entries(
        df.columns,
        lambda n: F.lit(places[n]).alias("position"),
        lambda n: F.lit(kinds[n]).alias("type"),
        lambda n: F.count(F.col(f"`{n}`")).alias("non_null"),
    ).alias("e"))
    return packed.select(F.explode("e").alias("e")).select("e.position", "e.column", "e.type", "e.non_null")


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, 25/50/75 %, max per numeric column, one row per column."""
    names = list(columns or numeric_names(df))
    moments = df.agg(_entries(
        names,
        lambda n: F.count(F.col(n)).alias("count"),
        lambda n: F.avg(F.col(n)).alias("mean"),
        lambda n: F.stddev_samp(F.col(n)).alias("std"),
        lambda n: F.min(F.col(n)).cast("double").alias("min"),
        lambda n: F.max(F.col(n)).cast("double").alias("max"),
    ).alias("e")).select(F.explode("e").alias("e")).select("e.*")
    long = exact_quantiles(df, names, [0.25, 0.5, 0.75])
    wide = long.groupBy("column").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(label)
        for p, label in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
    ])
    return moments.join(wide, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations, nulls included."""
    return df.select(*columns).distinct()


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """(column, distinct) with nulls excluded.

    Exact counting groups (column, value) pairs, so one shuffle serves all
    columns and no column's values meet in one task.
    """
    names = list(columns or df.columns)
    if approximate:
        packed = df.agg(_entries(names, lambda n: F.approx_count_distinct(F.col(f"`{n}`")).alias("distinct")).alias("e"))
        return packed.select(F.explode("e").alias("e")).select("e.*")
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("column"), _as_text(df, n).alias("value")) for n in names
    ])).alias("p")).select("p.*")
    found = pairs.groupBy("column", "value").agg(F.lit(1).alias("_one"))
    return found.groupBy("column").agg(F.count("value").alias("distinct"))


def _as_text(df: DataFrame, name: str) -> Column:
    """A column as text, with one zero: −0.0 is 0.0."""
    value = F.col(f"`{name}`")
    return (value + F.lit(0.0).cast(kind) if (kind := dict(df.dtypes)[name]) in ("float", "double") else value).cast("string")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row."""
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns or df.columns)
    packed = df.agg(_entries(names, lambda n: F.count_if(F.col(f"`{n}`").isNull()).alias("nulls")).alias("e"))
    return packed.select(F.explode("e").alias("e")).select("e.*")


def columns_with_nulls(df: DataFrame) -> DataFrame:
    return null_counts(df).where("nulls > 0").select("column")


def any_null_flags(df: DataFrame) -> DataFrame:
    """(column, has_null) from one pass."""
    packed = df.agg(_entries(df.columns, lambda n: F.bool_or(F.col(f"`{n}`").isNull()).alias("has_null")).alias("e"))
    return packed.select(F.explode("e").alias("e")).select("e.*")


def null_mask(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").isNull().alias(c) for c in columns or df.columns])


def null_patterns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How often each combination of missing columns occurs; 1 marks a missing cell."""
    bits = [F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in columns or df.columns]
    return df.groupBy(F.concat(*bits).alias("pattern")).agg(F.count(F.lit(1)).alias("rows"))


def keys_with_nulls(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    return df.where(any_null(columns or df.columns)).select(key)


def extremes(df: DataFrame, column: str) -> DataFrame:
    """min, max, mean and standard deviation (n - 1) of one column."""
    c = F.col(column)
    return df.agg(
        F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")
    )
