"""Filters, slices, sorts and appends."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.quantiles import quantile_table
from larkspur.operators.ranking import number_rows

# Up to here one task may hold the first rows of an order.
TOP_ROWS = 1_000_000


def keep_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def keep_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def keep_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def keep_above(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """Strictly above; a null never passes."""
    return df.where(F.col(column) > threshold)


def keep_box(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows inside every closed range."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).between(lo, hi) for c, (lo, hi) in bounds.items()]))


def split_equal(df: DataFrame, column: str, value) -> tuple[DataFrame, DataFrame]:
    """(rows equal to value, the other rows); a null goes with the others."""
    hit = F.col(column).eqNullSafe(F.lit(value))
    return df.where(hit), df.where(~hit)


def keep_non_zero(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) != 0)


def keep_match(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.where(F.col(column).rlike(pattern))


def keep_complete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=list(columns) if columns else None)


def keep_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.where(any_null(columns or df.columns))


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in columns])


def slice_rows(df: DataFrame, order: Sequence[Column | str], start: int, stop: int) -> DataFrame:
    """Rows ``start`` (inclusive, 0-based) to ``stop`` of the ordered table.

    Near the front a top-``stop`` finds them; further in, the rows are numbered.
    """
    if stop <= TOP_ROWS:
        return df.orderBy(*order).offset(start).limit(stop - start)
    return number_rows(df, order, name="_place").where(F.col("_place").between(start + 1, stop)).drop("_place")


def drop_first(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """All but the first n rows in a unique order: a top-n finds the boundary, the rest is a filter."""
    if n > TOP_ROWS:
        return number_rows(df, order, name="_place").where(F.col("_place") > n).drop("_place")
    place = F.struct(*[F.col(c) for c in order])
    boundary = df.select(*order).orderBy(*order).limit(n).agg(F.max(place)).scalar()
    return df.where(boundary.isNull() | (place > boundary))


def drop_last(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """All but the last n rows in a unique order."""
    if n > TOP_ROWS:
        rows = df.count()
        return number_rows(df, order, name="_place").where(F.col("_place") <= rows - n).drop("_place")
    place = F.struct(*[F.col(c) for c in order])
    tail = df.select(*order).orderBy(*[F.col(c).desc() for c in order]).limit(n)
    boundary = tail.agg(F.min(place)).scalar()
    return df.where(boundary.isNull() | (place < boundary))


def outlier_fence(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Keep ``q1 - factor*IQR <= x <= q3 + factor*IQR``."""
    q = quantile_table(df, column, {"q1": 0.25, "q3": 0.75})
    fence = q.select(F.struct(
        (F.col("q1") - factor * (F.col("q3") - F.col("q1"))).alias("lo"),
        (F.col("q3") + factor * (F.col("q3") - F.col("q1"))).alias("hi"),
    )).scalar()
    return df.where((F.col(column) >= fence["lo"]) & (F.col(column) <= fence["hi"]))


def sort_by(df: DataFrame, *keys: tuple[str, bool]) -> DataFrame:
    """Sort by ``(column, ascending)`` pairs."""
    return df.orderBy(*[F.col(c).asc() if up else F.col(c).desc() for c, up in keys])


def sort_by_magnitude(df: DataFrame, column: str, tie_break: Sequence[str]) -> DataFrame:
    return df.orderBy(F.abs(column).desc(), *tie_break)


def head(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def tail(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last n rows of a unique order, in that order."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n).orderBy(*order)


def append(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack tables by column name."""
    return reduce(lambda a, b: a.unionByName(b), others, first)


def append_results(spark, rows: Sequence[dict], schema: str) -> DataFrame:
    """One result row per loop step, built once at the end."""
    return spark.createDataFrame([tuple(r.values()) for r in rows], schema)
