"""Exact interpolated quantiles, per column and per group, without holding a group in one task.

``percentile`` keeps every distinct value of a group in memory. Here a bounded
sketch brackets each wanted rank, one more pass counts the values below and
inside each bracket, and only the values inside (about a thousandth of the
rows, equal values merged) are put in order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larkspur.operators.ranking import running_weight, small_side
from larkspur.session import checkpointed

ACCURACY = 10_000
MARGIN = 5.0 / ACCURACY
SINGLE_TASK_ROWS = 1_000_000
# Below this size a bracket would be narrower than a few ranks: take the whole group.
SMALL_GROUP_ROWS = 2 * ACCURACY


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Long table ``(*by, column, prob, value, n)``; nulls are skipped, columns without values left out."""
    keys = list(by)
    slim = df.select(*keys, *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(columns)])
    slots = [(i, p) for i in range(len(columns)) for p in probs]
    bracketed, cuts, sizes, largest = _brackets(slim, len(columns), probs, keys)

    inside = [F.col(f"_v{i}").between(lo, hi) for (i, _), (lo, hi) in zip(slots, cuts)]
    below = bracketed.groupBy(*keys).agg(F.array(*[
        F.count_if(F.col(f"_v{i}") < lo) for (i, _), (lo, _) in zip(slots, cuts)
    ]).alias("_below"))
    entries = bracketed.where(reduce(lambda a, b: a | b, inside)).select(*keys, F.explode(F.filter(
        F.array(*[F.when(hit, F.struct(F.lit(s).alias("slot"), F.col(f"_v{slots[s][0]}").alias("v"))) for s, hit in enumerate(inside)]),
        lambda e: e.isNotNull(),
    )).alias("e")).select(*keys, "e.slot", "e.v")
    counted = entries.groupBy(*keys, "slot", "v").agg(F.count(F.lit(1)).alias("_cnt"))

    group = [*keys, "slot"]
    if largest * 2 * MARGIN <= SINGLE_TASK_ROWS:
        order = W.partitionBy(*group).orderBy("v").rowsBetween(W.unboundedPreceding, 0)
        ranked = counted.withColumn("_upto", F.sum("_cnt").over(order))
    else:
        ranked = running_weight(counted, ["v"], "_cnt", group, "_upto")

    if keys:
        facts = below.join(sizes, [below[k].eqNullSafe(sizes[k]) for k in keys]).select(
            *[below[k].alias(f"_k{i}") for i, k in enumerate(keys)], "_below", "_n"
        )
        on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        located = ranked.join(facts, on).drop(*[f"_k{i}" for i in range(len(keys))])
    else:
        located = ranked.withColumn("_below", below.scalar()).withColumn("_n", sizes)
    column_of = F.array(*[F.lit(i) for i, _ in slots])
    prob = F.element_at(F.array(*[F.lit(float(p)) for _, p in slots]), F.col("slot") + 1)
    total = F.get("_n", F.get(column_of, "slot"))
    position = prob * (total - 1)
    upto = F.col("_upto") + F.get("_below", "slot")
    picked = located.groupBy(*group).agg(
        F.first(total).alias("n"),
        F.first(position).alias("_pos"),
        F.min_by("v", F.when(upto > F.floor(position), upto)).alias("_lo"),
        F.min_by("v", F.when(upto > F.ceil(position), upto)).alias("_hi"),
        F.min(upto - F.col("_cnt")).alias("_before"),
    )
    share = F.col("_pos") - F.floor("_pos")
    value = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(
        F.col("_lo") * (1 - share) + F.col("_hi") * share
    )
    # The sketch promises that the rank lies in its bracket; a wrong answer must not pass.
    missed = F.raise_error(F.lit("a quantile fell outside its bracket")).cast("double")
    checked = F.when(F.col("_before") > F.floor("_pos"), missed).otherwise(F.coalesce(value, missed))
    name = F.element_at(F.array(*[F.lit(columns[i]) for i, _ in slots]), F.col("slot") + 1)
    return picked.select(*keys, name.alias("column"), prob.alias("prob"), checked.alias("value"), "n")


def _brackets(slim: DataFrame, width: int, probs: Sequence[float], keys: list[str]):
    """Rows with their brackets in reach: (rows, (low, high) per slot, sizes, largest group)."""
    points = [max(p - MARGIN, 0.0) for p in probs] + [min(p + MARGIN, 1.0) for p in probs]
    values = [F.col(f"_v{i}") for i in range(width)]

    def bracket_ends(v: Column) -> Column:
        whole = F.array(*[F.min(v)] * len(probs), *[F.max(v)] * len(probs))
        return F.when(F.count(v) <= SMALL_GROUP_ROWS, whole).otherwise(F.percentile_approx(v, points, ACCURACY))

    sketch = slim.groupBy(*keys).agg(
        F.array(*[F.count(v) for v in values]).alias("_n"), F.array(*[bracket_ends(v) for v in values]).alias("_cut")
    )
    places = [(i, j) for i in range(width) for j in range(len(probs))]
    if not keys:
        # One row of bounded size: as literals the brackets reach the file scan.
        row = sketch.first()
        cuts = [
            tuple(F.lit(row["_cut"][i][at] if row["_cut"][i] else None).cast("double") for at in (j, j + len(probs)))
            for i, j in places
        ]
        return slim, cuts, F.array(*[F.lit(n) for n in row["_n"]]), max(row["_n"])
    sketch = checkpointed(sketch)
    largest = sketch.agg(F.max(F.array_max("_n"))).first()[0] or 0
    right = small_side(sketch.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_cut"))
    rows = slim.join(right, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]).drop(
        *[f"_k{i}" for i in range(len(keys))]
    )
    cuts = [(F.col("_cut")[i][j], F.col("_cut")[i][j + len(probs)]) for i, j in places]
    return rows, cuts, sketch.select(*keys, "_n"), largest


def quantile_table(
    df: DataFrame, column: str, names: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """One row per group with one named column per wanted quantile of ``column``."""
    long = exact_quantiles(df, [column], list(names.values()), by)
    return long.groupBy(*by).agg(*[
        F.max(F.when(F.abs(F.col("prob") - p) < 1e-12, F.col("value"))).alias(name) for name, p in names.items()
    ])
