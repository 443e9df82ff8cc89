"""Choosing, naming, casting and rounding columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def select_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{n}`") for n in names])


def select_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    return select_names(df, [df.columns[i] for i in positions])


def drop_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    return df.drop(*[df.columns[i] for i in positions])


def drop_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def select_prefix(df: DataFrame, *prefixes: str) -> DataFrame:
    return select_names(df, [c for c in df.columns if c.startswith(prefixes)])


def drop_prefix_columns(df: DataFrame, *prefixes: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefixes)])


def numeric_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def select_types(df: DataFrame, *types: type) -> DataFrame:
    return select_names(df, [f.name for f in df.schema.fields if isinstance(f.dataType, types)])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def rename_pattern(df: DataFrame, pattern: str, replacement: str = "") -> DataFrame:
    return df.toDF(*[re.sub(pattern, replacement, c) for c in df.columns])


def move_column(df: DataFrame, name: str, after: str | None = None) -> DataFrame:
    """Move a column behind another one, or to the front."""
    rest = [c for c in df.columns if c != name]
    at = rest.index(after) + 1 if after else 0
    return select_names(df, [*rest[:at], name, *rest[at:]])


def add_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast several columns in one projection; values that do not fit become null."""
    return df.withColumns({name: F.col(f"`{name}`").try_cast(kind) for name, kind in types.items()})


def round_columns(df: DataFrame, digits: int, names: Sequence[str] | None = None) -> DataFrame:
    """Round the named columns, or every fractional one."""
    fractional = (T.DoubleType, T.FloatType, T.DecimalType)
    chosen = names or [f.name for f in df.schema.fields if isinstance(f.dataType, fractional)]
    return df.withColumns({n: F.round(F.col(f"`{n}`"), digits) for n in chosen})


def row_sum(names: Sequence[str]) -> Column:
    """Sum across columns; null if any of them is null."""
    return reduce(lambda a, b: a + b, [F.col(f"`{n}`") for n in names])


def split_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """(predictors, target)"""
    return df.drop(target), df.select(target)


def on_each(names: Sequence[str], expression) -> list[Column]:
    """Apply one expression builder to several columns, keeping their names."""
    return [expression(F.col(f"`{n}`")).alias(n) for n in names]
