"""Generated tables and small fixtures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.operators.sampling import hash_share


def linear_sample(spark: SparkSession, n: int, seed: int, intercept: float = 2.0, slope: float = 3.0) -> DataFrame:
    """``y = intercept + slope * x + U(0, 1)`` with ``x ~ U(0, 1)``."""
    drawn = spark.range(n).select("id", F.rand(seed).alias("x"), F.rand(seed + 1).alias("_noise"))
    return drawn.select("id", "x", (intercept + slope * F.col("x") + F.col("_noise")).alias("y"))


def linear_from_keys(
    df: DataFrame, keys: Sequence[str], seed: int, intercept: float = 2.0, slope: float = 3.0
) -> DataFrame:
    """The same sample, one row per row of ``df``, repeatable in any layout."""
    x, noise = hash_share(keys, seed), hash_share(keys, seed + 1)
    return df.select(*keys, x.alias("x"), (intercept + slope * x + noise).alias("y"))


def patients(spark: SparkSession, n: int = 442, seed: int = 7) -> DataFrame:
    """A sample table of patients: age, sex, bmi, bp, six serum values and a target."""
    serum = [F.randn(seed + i).alias(f"s{i}") for i in range(1, 7)]
    base = spark.range(n).select(
        (F.lit(20) + F.floor(F.rand(seed) * 60)).cast("int").alias("age"),
        F.when(F.rand(seed + 10) < 0.5, "female").otherwise("male").alias("sex"),
        (26 + 4 * F.randn(seed + 11)).alias("bmi"),
        (95 + 14 * F.randn(seed + 12)).alias("bp"),
        *serum,
    )
    return base.withColumn("target", 150 + 6 * (F.col("bmi") - 26) + F.col("bp") * 0.4 + 20 * F.col("s5"))


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A local fixture as a table."""
    return spark.createDataFrame(list(rows), schema)
