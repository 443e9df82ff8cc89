"""Delimited text in its untidy forms. Schemas are given, never inferred by a second scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.dates import parse_date


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    multi_line: bool = False,
    comment: str | None = None,
) -> DataFrame:
    """CSV with quoted fields, doubled quotes, and optionally line breaks inside quotes.

    A multi-line file cannot be split, so write such data as many files.
    Without a schema the types are inferred, which costs an extra scan and
    suits exploration only.
    """
    reader = (
        spark.read.option("header", header).option("sep", sep).option("multiLine", multi_line)
        .option("quote", '"').option("escape", '"').option("nanValue", "NaN")
    )
    if comment:
        reader = reader.option("comment", comment)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, header: bool = True) -> DataFrame:
    return read_csv(spark, path, schema, sep="\t", header=header)


def read_after_preamble(
    spark: SparkSession, path: str, date: str, values: Sequence[str], preamble: Sequence[str], formats: Sequence[str] = ("yyyy-MM-dd",)
) -> DataFrame:
    """A dated CSV below title lines and a header.

    ``preamble`` lists the first fields of the lines that are no data. Every other
    row is kept; a date that no format reads, or an unreadable number, is null.
    """
    names = [date, *values]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.option("header", False).schema(schema).csv(path)
    data = raw.where(~F.coalesce(F.col(f"`{date}`"), F.lit("")).isin(list(preamble)))
    dated = data.withColumn(date, parse_date(F.col(f"`{date}`"), list(formats)))
    return dated.select(date, *[F.col(f"`{v}`").try_cast("double").alias(v) for v in values])


def read_quoted_words(spark: SparkSession, path: str, width: int) -> DataFrame:
    """Whitespace-separated fields, some in double quotes, no header: columns ``V1..Vn``."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    fields = F.regexp_extract_all("value", F.lit(r'"[^"]*"|\S+'), F.lit(0))
    split = lines.select(fields.alias("f"))
    return split.select(*[F.regexp_replace(F.get("f", F.lit(i)), '^"|"$', "").alias(f"V{i + 1}") for i in range(width)])


def as_categories(df: DataFrame, columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Add a 1-based code per text column, levels in alphabetical order; a null has no code."""
    codes = [f"{c}{suffix}" for c in columns]
    indexer = StringIndexer(
        inputCols=list(columns), outputCols=codes, stringOrderType="alphabetAsc", handleInvalid="keep"
    ).fit(df)
    out = indexer.transform(df)
    return out.withColumns({
        code: F.when(F.col(c).isNotNull(), (F.col(code) + 1).cast("int")) for c, code in zip(columns, codes)
    })
