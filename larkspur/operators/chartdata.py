"""The aggregates behind charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.aggregates import group_count
from larkspur.operators.ranking import small_side
from larkspur.session import checkpointed
from larkspur.operators.quantiles import quantile_table


def _range(df: DataFrame, column: str) -> Column:
    lo, hi = F.min(column).cast("double"), F.max(column).cast("double")
    flat = lo == hi
    return df.select(F.struct(
        F.when(flat, lo - 0.5).otherwise(lo).alias("lo"), F.when(flat, hi + 0.5).otherwise(hi).alias("hi")
    )).scalar()


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal bins between the extremes; the maximum falls in the last bin.

    Without groups every bin is listed, empty ones with 0; with groups the bins
    are shared and only occupied ones are listed.
    """
    ends = _range(df, column)
    width = (ends["hi"] - ends["lo"]) / bins
    place = F.least(F.floor((F.col(column) - ends["lo"]) / width).cast("int"), F.lit(bins - 1))
    counts = group_count(df.where(F.col(column).isNotNull()).select(*by, place.alias("bin")), [*by, "bin"])
    if not by:
        every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
        counts = every.join(counts, "bin", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    start = ends["lo"] + F.col("bin") * width
    return counts.select(*by, "bin", start.alias("start"), (start + width).alias("stop"), "count")


def histogram_width(df: DataFrame, column: str, width: float, by: Sequence[str] = ()) -> DataFrame:
    """Occupied bins of a fixed width, aligned at multiples of it."""
    place = (F.floor(F.col(column) / F.lit(float(width))) * F.lit(float(width))).alias("start")
    return group_count(df.where(F.col(column).isNotNull()).select(*by, place), [*by, "start"])


def box_summary(df: DataFrame, column: str, by: Sequence[str] = (), factor: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the last points inside the fence, and the number of outliers."""
    marked = _fenced(df, column, by, factor)
    x, inside = F.col(column), F.col("_inside")
    return marked.groupBy(*by).agg(
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def box_outliers(df: DataFrame, column: str, by: Sequence[str] = (), factor: float = 1.5) -> DataFrame:
    """The rows outside their group's fence."""
    return _fenced(df, column, by, factor).where(~F.col("_inside")).select(*df.columns)


def _fenced(df: DataFrame, column: str, by: Sequence[str], factor: float) -> DataFrame:
    quartiles = quantile_table(df, column, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)
    values = df.where(F.col(column).isNotNull())
    if by:
        joined = values.join(small_side(checkpointed(quartiles)), list(by))
    else:
        row = quartiles.select(F.struct("q1", "median", "q3")).scalar()
        joined = values.withColumn("_q", row).select("*", "_q.*").drop("_q")
    reach = factor * (F.col("q3") - F.col("q1"))
    inside = F.col(column).between(F.col("q1") - reach, F.col("q3") + reach)
    return joined.withColumn("_inside", inside)


def bars(df: DataFrame, category: str, value: Column, k: int | None = None) -> DataFrame:
    """One bar per category, tallest first, the first k of them if asked."""
    out = df.groupBy(category).agg(value.alias("value")).orderBy(F.col("value").desc(), F.col(category).asc())
    return out.limit(k) if k else out


def bars_in_order(df: DataFrame, category: str, value: Column, order: Sequence[str]) -> DataFrame:
    """One bar per category in a given order of categories."""
    rank = F.array_position(F.array(*[F.lit(c) for c in order]), F.col(category)).alias("rank")
    out = df.groupBy(category).agg(value.alias("value"))
    return out.select(rank, category, "value").where("rank > 0").orderBy("rank")


def bubbles(df: DataFrame, x: str, y: str) -> DataFrame:
    """How often each (x, y) pair occurs."""
    return group_count(df, [x, y])


def group_mean_marks(df: DataFrame, by: str, column: str) -> DataFrame:
    return df.groupBy(by).agg(F.avg(column).alias("mean"))


def straight_line(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Slope, intercept and end points of the least-squares line."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return both.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.min(x).alias("x_min"),
        F.max(x).alias("x_max"),
    )


def _density_shape(df: DataFrame, column: str):
    """Smallest value, range, Scott's bandwidth and number of values, as one scalar struct."""
    n = F.count(F.col(column)).cast("double")
    lo, hi = F.min(column).cast("double"), F.max(column).cast("double")
    return df.select(F.struct(
        lo.alias("lo"), (hi - lo).alias("span"), (F.stddev_samp(column) * F.pow(F.when(n > 0, n), F.lit(-0.2))).alias("h"), n.alias("n"),
    )).scalar()


def _density_curve(values: DataFrame, shape, points: int) -> DataFrame:
    """(k, x, density) from weighted values (x, w): one running sum per point of the grid, merged map-side."""
    s = F.col("s")
    step = 2 * s["span"] / (points - 1)
    scaled = values.withColumn("s", shape).select(
        "w", F.try_divide(F.col("x") - s["lo"] + 0.5 * s["span"], s["h"]).alias("z"), F.try_divide(step, s["h"]).alias("g"))
    off = [F.col("z") - k * F.col("g") for k in range(points)]
    sums = scaled.agg(F.array(*[F.sum(F.col("w") * F.exp(-0.5 * o * o)) for o in off]).alias("sums")).where(F.size("sums") > 0).withColumn("s", shape)
    cells = sums.where(s["n"] > 0).select("s", F.posexplode("sums").alias("k", "sum"))
    return cells.select("k", (s["lo"] - 0.5 * s["span"] + F.col("k") * step).alias("x"), F.try_divide("sum", s["n"] * s["h"] * F.sqrt(F.lit(2.0) * F.pi())).alias("density"))


def density(df: DataFrame, column: str, points: int = 100) -> DataFrame:
    """Gaussian kernel density on a grid half a range wider than the data on each side.

    Bandwidth by Scott's rule; a column without spread has null densities. Every
    value adds to one running sum per point of the grid, merged map-side, so no
    value is shuffled. ``binned_density`` is cheaper for large tables.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x"), F.lit(1.0).alias("w"))
    return _density_curve(values, _density_shape(df, column), points)


def binned_density(df: DataFrame, column: str, points: int = 100, steps: int = 50) -> DataFrame:
    """``density`` from counts on a fine grid of ``steps`` places per bandwidth.

    Each value is shared between its two neighbours on the fine grid, in proportion.
    That is linear interpolation of the kernel, whose second derivative is at most
    its height, so the curve is off by no more than 1 / (8 ``steps``²) of the
    kernel's height 0.4 / bandwidth. Counts and shares are merged map-side; only
    places that hold values are kept, and the kernel is summed over these.
    """
    shape = _density_shape(df, column)
    s = F.col("s")
    spot = F.try_divide((F.col(column).cast("double") - s["lo"]) * steps, s["h"])
    placed = df.where(F.col(column).isNotNull()).withColumn("s", shape).select(F.coalesce(spot, F.lit(0.0)).alias("u"))
    bins = placed.groupBy(F.floor("u").alias("b")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("u") - F.floor("u")).alias("right"))
    sides = F.array(F.struct(F.col("b").alias("b"), (F.col("n") - F.col("right")).alias("w")), F.struct((F.col("b") + 1).alias("b"), F.col("right").alias("w")))
    values = bins.select(F.explode(sides).alias("p")).withColumn("s", shape).select((s["lo"] + F.col("p.b") * s["h"] / steps).alias("x"), F.col("p.w").alias("w"))
    return _density_curve(values, shape, points)


def value_per_region(df: DataFrame, region: str, value: str) -> DataFrame:
    return df.where(F.col(region).isNotNull()).groupBy(region).agg(F.sum(value).alias("value"))
