"""Row positions and top-n without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larkspur.session import checkpointed


def _null_safe(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


#: Tables of at most so many rows, counted after they are written, go to every task.
BROADCAST_ROWS = 100_000


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` for a broadcast join if it was counted to be small, else as it is, for a shuffle join.

    Spark guesses the size of an aggregate from its input, so it would shuffle a
    large table on a few keys for the sake of a table of a few rows. ``df`` should
    be checkpointed; both ways give the same rows.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def number_rows(
    df: DataFrame, order: Sequence[Column | str], by: Sequence[str] = (), name: str = "row_number"
) -> DataFrame:
    """1-based position in a total order, over the table or within each of a few groups.

    The rows are range-partitioned on the composite key, so neither the whole
    table nor a hot group has to fit one task; each row's position is its place
    inside its partition plus the rows before that partition. ``order`` must be
    unique. For many small groups a plain window is the better tool.
    """
    keys = [F.col(k) for k in by] + [F.col(o) if isinstance(o, str) else o for o in order]
    placed = checkpointed(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
    ).withColumn("_pid", F.shiftright("_mid", 33))
    sizes = placed.groupBy("_pid", *by).agg(F.count(F.lit(1)).alias("_rows"), F.min("_mid").alias("_first"))
    before = W.partitionBy(*by).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    offsets = small_side(checkpointed(offsets))
    joined = placed.alias("p").join(offsets.alias("o"), _null_safe("p", "o", ["_pid", *by]), "left")
    position = F.col("o._before") + F.col("p._mid") - F.col("o._first") + 1
    return joined.select(*[F.col(f"p.`{c}`") for c in df.columns], position.alias(name))


def running_weight(df: DataFrame, order: Sequence[str], weight: str, by: Sequence[str], name: str) -> DataFrame:
    """Running total of ``weight`` within ``by`` for groups too large for one window task."""
    keys = [*by, *order]
    placed = checkpointed(
        df.repartitionByRange(*keys).withColumn("_pid", F.spark_partition_id())
    )
    sizes = placed.groupBy("_pid", *by).agg(F.sum(weight).alias("_sum"))
    before = W.partitionBy(*by).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    offsets = small_side(checkpointed(offsets))
    inside = W.partitionBy("_pid", *by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = placed.withColumn("_inside", F.sum(weight).over(inside))
    joined = local.alias("p").join(offsets.alias("o"), _null_safe("p", "o", ["_pid", *by]), "left")
    return joined.select(
        *[F.col(f"p.`{c}`") for c in df.columns], (F.col("_inside") + F.col("_before")).alias(name)
    )


def top_n(df: DataFrame, column: str, n: int, tie_break: Sequence[str], largest: bool = True) -> DataFrame:
    """The n rows with the largest (or smallest) value; ties fall to ``tie_break`` ascending."""
    first = F.col(column).desc_nulls_last() if largest else F.col(column).asc_nulls_last()
    return df.orderBy(first, *[F.col(t).asc() for t in tie_break]).limit(n)


def first_rows_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column | str], n: int, spread: Sequence[str], salts: int = 256
) -> DataFrame:
    """The first n rows of each group, as a tournament, so that no task sorts a whole hot group.

    A row outside the first n of any part of its group is outside the first n
    of the group. The parts are the input partitions, then ``salts`` slices on a
    hash of ``spread``, then the group. Up to
    ``spark.sql.optimizer.windowGroupLimitThreshold`` Spark also prunes before
    each shuffle.
    """
    slice_of = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(salts))
    kept = df.withColumns({"_part": F.spark_partition_id(), "_slice": slice_of})
    for part in (["_part"], ["_slice"], []):
        within = W.partitionBy(*by, *part).orderBy(*order)
        kept = kept.withColumn("_rn", F.row_number().over(within)).where(F.col("_rn") <= n).drop("_rn")
    return kept.drop("_part", "_slice")
