"""Grouped summaries, cross tables, scaling and correlation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.gram import correlation_cells
from larkspur.operators.columns import numeric_names
from larkspur.operators.quantiles import exact_quantiles, quantile_table

PAIRWISE_COLUMNS = 12


def _with_keys(df: DataFrame, keys: Sequence[str], drop_null_keys: bool) -> DataFrame:
    """Without null keys if asked; written as IS NOT NULL, which reaches the file scan."""
    return reduce(lambda d, k: d.where(F.col(k).isNotNull()), keys, df) if drop_null_keys else df


def group_sum(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, drop_null_keys: bool = True
) -> DataFrame:
    """Sum the named (default: all other numeric) columns per key combination."""
    measures = list(columns or [c for c in numeric_names(df) if c not in keys])
    return _with_keys(df, keys, drop_null_keys).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in measures])


def group_mean(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], drop_null_keys: bool = True
) -> DataFrame:
    return _with_keys(df, keys, drop_null_keys).groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def group_named(df: DataFrame, keys: Sequence[str], drop_null_keys: bool = False, **aggregates: Column) -> DataFrame:
    """Several named aggregates in one pass."""
    return _with_keys(df, keys, drop_null_keys).groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()])


def group_count(
    df: DataFrame, keys: Sequence[str], name: str = "count", drop_null_keys: bool = False
) -> DataFrame:
    return _with_keys(df, keys, drop_null_keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def frequency(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """Rows per value, most frequent first."""
    return group_count(df, [key], name).orderBy(F.col(name).desc(), F.col(key).asc())


def group_sum_all_levels(df: DataFrame, key: str, levels: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Sums in a fixed order of categories; a category without rows is kept with 0."""
    dimension = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(v) for v in levels])).alias("rank", key))
    sums = group_sum(df, [key], columns)
    return dimension.join(sums, key, "left").select(
        "rank", key, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in columns]
    )


def group_median(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Medians over rows complete in all the columns."""
    long = exact_quantiles(df.dropna(subset=list(columns)), columns, [0.5], keys)
    return long.groupBy(*keys).agg(*[
        F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns
    ])


def segment_profile(df: DataFrame, segment: str, features: Sequence[str], digits: int = 4) -> DataFrame:
    """Mean of every feature and the size of each segment."""
    return df.groupBy(segment).agg(
        *[F.round(F.avg(f), digits).alias(f) for f in features], F.count(F.lit(1)).alias("count")
    )


def subtotals(df: DataFrame, outer: str, inner: str, **sums: Column) -> DataFrame:
    """Sums per (outer, inner) and per outer, told apart by ``level``.

    The fine grain is aggregated first; the coarse rows are sums of fine rows,
    so the table is read and shuffled once.
    """
    fine = df.groupBy(outer, inner).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    rolled = fine.groupingSets([[outer, inner], [outer]], outer, inner).agg(
        F.grouping(inner).cast("int").alias("level"), *[F.sum(n).alias(n) for n in sums]
    )
    return rolled.select(outer, inner, "level", *sums)


def pivot_by_date(df: DataFrame, date: str) -> DataFrame:
    """Sum of every measure per date; text columns fall away."""
    return group_sum(df, [date])


def cross_table(df: DataFrame, rows: str, columns: str, levels: Sequence) -> DataFrame:
    """Counts with one column per listed level."""
    counted = df.groupBy(rows, columns).agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(rows).agg(*[
        F.coalesce(F.sum(F.when(F.col(columns) == F.lit(v), F.col("_n"))), F.lit(0)).alias(str(v)) for v in levels
    ])


def levels_of(df: DataFrame, column: str, limit: int = 10_000) -> list:
    """Sorted distinct values for use as output columns; refuses an open-ended column."""
    found = [r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} levels")
    return sorted(found)


def quantiles(df: DataFrame, column: str, names: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    return quantile_table(df, column, names, by)


def correlation(a: Column | str, b: Column | str) -> Column:
    """Correlation over rows where both are present; null where one does not vary."""
    x, y = (F.col(c).cast("double") if isinstance(c, str) else c.cast("double") for c in (a, b))
    both = x.isNotNull() & y.isNotNull()
    spread = F.sqrt(F.var_pop(F.when(both, x))) * F.sqrt(F.var_pop(F.when(both, y)))
    return F.try_divide(F.covar_pop(x, y), spread)


def pearson(df: DataFrame, a: str, b: str) -> DataFrame:
    """Correlation over rows where both columns are present; null where one does not vary."""
    return df.agg(correlation(a, b).alias("corr"))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None, digits: int | None = None) -> DataFrame:
    """Long matrix ``(i, j, var1, var2, corr)`` over complete rows, from one pass.

    A few columns are one aggregate of pairwise correlations and stay lazy; many
    are one pass of cross products in blocks, and the cells are made from these in
    tasks. Either way a column without spread has null correlations, with itself too.
    """
    names = list(columns or numeric_names(df))
    complete = df.select(*[F.col(n).cast("double").alias(n) for n in names]).dropna()
    if len(names) <= PAIRWISE_COLUMNS:
        cells = [
            F.struct(
                F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(a).alias("var1"), F.lit(b).alias("var2"),
                correlation(names[min(i, j)], names[max(i, j)]).alias("corr"),
            ) for i, a in enumerate(names) for j, b in enumerate(names)
        ]
        matrix = complete.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("c")).select("c.*")
    else:
        label = F.array(*[F.lit(n) for n in names])
        cells = correlation_cells(complete, names)
        matrix = cells.select("i", "j", F.get(label, F.col("i")).alias("var1"), F.get(label, F.col("j")).alias("var2"), "corr")
    return matrix if digits is None else matrix.withColumn("corr", F.round("corr", digits))


def triangle(matrix: DataFrame, upper: bool = True, diagonal: bool = True) -> DataFrame:
    """Cells on one side of the diagonal."""
    i, j = (F.col("i"), F.col("j")) if upper else (F.col("j"), F.col("i"))
    return matrix.where(i <= j if diagonal else i < j)


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "variable", value: str = "value") -> DataFrame:
    """Wide to long; empty cells are dropped."""
    return df.unpivot(list(ids), list(values), name, value).dropna(subset=[value])


def strongest_pairs(matrix: DataFrame, n: int) -> DataFrame:
    """The n most correlated pairs by absolute value, each pair once."""
    pairs = triangle(matrix, diagonal=False).where(F.col("corr").isNotNull() & ~F.isnan("corr"))
    return pairs.orderBy(F.abs("corr").desc(), "var1", "var2").limit(n).select("var1", "var2", "corr")


def mean_absolute(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.avg(F.abs(column)).alias("mean_abs"))


def min_max_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale to [0, 1] by the table's extremes; a constant column gives null."""
    ends = df.select(F.struct(
        *[F.min(c).alias(f"lo_{c}") for c in columns], *[F.max(c).alias(f"hi_{c}") for c in columns]
    )).scalar()
    span = {c: ends[f"hi_{c}"] - ends[f"lo_{c}"] for c in columns}
    return df.withColumns({
        c: (F.col(c) - ends[f"lo_{c}"]) / F.when(span[c] != 0, span[c]) for c in columns
    })
