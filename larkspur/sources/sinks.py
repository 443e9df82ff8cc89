"""Writers and hand-off to the client."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from larkspur.operators.ranking import number_rows


def write_csv(
    df: DataFrame, path: str, sep: str = ",", header: bool = True, index_order: Sequence[str] | None = None
) -> str:
    """Write CSV files; with ``index_order`` a 0-based row index in that order comes first."""
    if index_order:
        numbered = number_rows(df, list(index_order), name="_place")
        df = numbered.selectExpr("_place - 1 AS row_index", *[f"`{c}`" for c in df.columns])
    (
        df.write.option("header", header).option("sep", sep).option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return path


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    df.write.partitionBy(*partition_by).parquet(path)
    return path


def save_fitted(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_fitted(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def register_view(df: DataFrame, name: str) -> SparkSession:
    """Make a table available to SQL text; returns the session to query."""
    df.createOrReplaceTempView(name)
    return df.sparkSession


def collect_small(df: DataFrame, limit: int = 100_000) -> pd.DataFrame:
    """Bring an aggregated result to the client; refuses more than ``limit`` rows."""
    local = df.limit(limit + 1).toPandas()
    if len(local) > limit:
        raise ValueError(f"more than {limit} rows: aggregate first")
    return local
