"""Joins.

No broadcast hints on tables whose size is unknown: Spark broadcasts a side
once its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise shuffles, where adaptive execution splits a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_KEYS = 100_000


def lookup_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, columns: Sequence[str]
) -> DataFrame:
    """Left join on differently named keys, bringing over some right columns."""
    slim = right.select(F.col(right_key).alias("_key"), *columns)
    return left.join(slim, F.col(left_key) == F.col("_key"), "left").drop("_key")


def left_join(left: DataFrame, right: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return left.join(right, on, "left")


def inner_chain(tables: Sequence[DataFrame], on: Sequence[str] | str) -> DataFrame:
    """Inner join of several aggregates that share their grouping key."""
    return reduce(lambda a, b: a.join(b, on, "inner"), tables)


def align(left: DataFrame, right: DataFrame, index: str, column: str, name: str | None = None) -> DataFrame:
    """Attach one column by index value; index values missing on the right give null."""
    return left.join(right.select(index, F.col(column).alias(name or column)), index, "left")


def update_rows(df: DataFrame, changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Overwrite ``columns`` where ``changes`` holds a non-null value for the key."""
    new = changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = df.join(new, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(f"_new_{c}"), F.col(c)) for c in columns}).select(*df.columns)


def anti_join(left: DataFrame, right: DataFrame, on: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``left`` without a match on all shared columns; nulls match nulls."""
    shared = list(on or [c for c in left.columns if c in right.columns])
    keys = right.select(*[F.col(c).alias(f"_r_{c}") for c in shared]).distinct()
    condition = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in shared])
    return left.join(keys, condition, "left_anti")


def semi_join_top(df: DataFrame, key: str, score, n: int) -> DataFrame:
    """Rows whose key is among the n highest-scoring keys; ``score`` is an aggregate column.

    The n keys are broadcast while n keeps them small.
    """
    best = df.groupBy(key).agg(score.alias("_score")).orderBy(F.col("_score").desc(), F.col(key).asc()).limit(n)
    keys = best.select(key)
    return df.join(F.broadcast(keys) if n <= BROADCAST_KEYS else keys, key, "left_semi")
