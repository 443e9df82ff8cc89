"""Calendar bins with empty periods kept, and series extension.

Rows are aggregated to the period before anything is ordered, so every later
window holds at most one row per key and period.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larkspur.functions.dates import month_end, month_start, week_ending_sunday, week_starting_monday

_STEP_DAYS = {"week_sunday": 7, "week_monday": 7, "day": 1}
_LABELS = {
    "week_sunday": week_ending_sunday,
    "week_monday": week_starting_monday,
    "month": month_end,
    "day": F.to_date,
}


def period_label(col: Column, period: str) -> Column:
    return _LABELS[period](col)


def dense(grouped: DataFrame, label: str, period: str, by: Sequence[str] = ()) -> DataFrame:
    """Add the missing periods between each key's first and last one, with nulls in the other columns.

    ``grouped`` has one row per key and period. Every row fills the gap up to
    its successor, so the source is read once and nothing is joined.
    """
    after = F.lead(label).over(W.partitionBy(*by).orderBy(label))
    if period == "month":
        until = F.add_months(month_start(F.col("_next")), -1)
        gap = F.transform(F.sequence(month_start(F.col(label)), until, F.expr("interval 1 month")), lambda m: F.last_day(m))
    else:
        step = _STEP_DAYS[period]
        gap = F.sequence(F.col(label), F.date_sub("_next", step), F.expr(f"interval {step} days"))
    slots = F.when(F.col("_next").isNull(), F.array(label)).otherwise(gap)
    spread = grouped.withColumn("_next", after).withColumn("_slot", F.explode(slots))
    real = F.col("_slot") == F.col(label)
    others = [c for c in grouped.columns if c not in (*by, label)]
    return spread.select(*by, F.col("_slot").alias(label), *[F.when(real, F.col(c)).alias(c) for c in others])


def resample(
    df: DataFrame,
    ts: str,
    period: str,
    sums: Sequence[str] = (),
    means: Sequence[str] = (),
    by: Sequence[str] = (),
    label: str = "period",
) -> DataFrame:
    """Sums and means per period; an empty period has sum 0 and a null mean."""
    binned = df.withColumn(label, period_label(F.col(ts), period)).where(F.col(label).isNotNull())
    grouped = binned.groupBy(*by, label).agg(
        *[F.sum(c).alias(f"sum_{c}") for c in sums], *[F.avg(c).alias(f"mean_{c}") for c in means]
    )
    return dense(grouped, label, period, by).select(
        *by,
        label,
        *[F.coalesce(F.col(f"sum_{c}"), F.lit(0)).alias(f"sum_{c}") for c in sums],
        *[f"mean_{c}" for c in means],
    )


def extend(df: DataFrame, ds: str, n: int, step_days: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """Append n future dates per key; the other columns are null there.

    The last row of a series spawns the future ones, so the source is read once.
    """
    is_last = F.lead(ds).over(W.partitionBy(*by).orderBy(ds)).isNull()
    ahead = F.when(F.col("_last"), F.sequence(F.lit(0), F.lit(n))).otherwise(F.array(F.lit(0)))
    spread = df.withColumn("_last", is_last).withColumn("_ahead", F.explode(ahead))
    moved = F.date_add(ds, (F.col("_ahead") * step_days).cast("int"))
    return spread.select(*[
        F.col(c) if c in by else moved.alias(c) if c == ds else F.when(F.col("_ahead") == 0, F.col(c)).alias(c)
        for c in df.columns
    ])
