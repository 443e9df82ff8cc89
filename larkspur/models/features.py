"""Feature columns, encoders and reductions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import (
    PCA, Imputer, MinMaxScaler, OneHotEncoder, RFormula, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.gram import cross_products, gather
from larkspur.operators.aggregates import levels_of


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features", invalid: str = "skip") -> DataFrame:
    """Numeric columns to one vector; rows with a null are left out.

    ``invalid="error"`` spares the check per column where nulls cannot occur and
    the columns are costly to compute.
    """
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=invalid).transform(df)


def dummies(df: DataFrame, columns: Sequence[str], drop_first: bool = False) -> DataFrame:
    """Replace text columns by 0/1 columns ``column_level``; a null is 0 everywhere."""
    added = {}
    for column in columns:
        for level in levels_of(df, column)[1 if drop_first else 0:]:
            added[f"{column}_{level}"] = F.when(F.col(column) == F.lit(level), 1).otherwise(0)
    return df.select(*[c for c in df.columns if c not in columns], *[e.alias(n) for n, e in added.items()])


class _TextMode(HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    fillValues = Param(
        Params._dummy(), "fillValues", "one replacement per input column", typeConverter=TypeConverters.toListString
    )


class TextModeModel(Model, _TextMode):
    """Fills nulls of text columns with the values found at fitting time."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, fillValues=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.fillValues))
        return dataset.withColumns({out: F.coalesce(F.col(c), F.lit(v)) for c, out, v in names})


class TextMode(Estimator, _TextMode):
    """Learns the most frequent value of each text column (first in order among equals)."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TextModeModel:
        found = []
        for column in self.getInputCols():
            counts = dataset.where(F.col(column).isNotNull()).groupBy(column).count()
            best = counts.orderBy(F.col("count").desc(), F.col(column)).first()
            found.append(best[0] if best else "")
        return TextModeModel(inputCols=self.getInputCols(), outputCols=self.getOutputCols(), fillValues=found)


def one_hot_stages(columns: Sequence[str], levels_seen: Mapping[str, int], prefix: str) -> list:
    """Indicator vectors without the first level; a level unseen in training gives zeros.

    The extra slot that ``handleInvalid='keep'`` adds for unseen levels is the
    last one, which the encoder drops.
    """
    stages = []
    for column in columns:
        index, hot, cut = f"{prefix}__{column}_index", f"{prefix}__{column}_hot", f"{prefix}__{column}"
        stages += [
            StringIndexer(inputCol=column, outputCol=index, handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=[index], outputCols=[hot], dropLast=True),
            VectorSlicer(inputCol=hot, outputCol=cut, indices=list(range(1, levels_seen[column]))),
        ]
    return stages


def numeric_stages(columns: Sequence[str], prefix: str) -> list:
    """Mean imputation, then min-max scaling: one vector ``prefix``."""
    filled = [f"{prefix}__{c}" for c in columns]
    return [
        Imputer(strategy="mean", inputCols=list(columns), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol=f"{prefix}__raw"),
        MinMaxScaler(inputCol=f"{prefix}__raw", outputCol=prefix),
    ]


def categorical_stages(df: DataFrame, columns: Sequence[str], prefix: str) -> list:
    """Mode imputation, then one-hot without the first level."""
    filled = [f"{c}_filled" for c in columns]
    seen = {f"{c}_filled": len(levels_of(df, c)) for c in columns}
    return [TextMode(inputCols=list(columns), outputCols=filled), *one_hot_stages(filled, seen, prefix)]


def preparation(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], passthrough: Sequence[str] = ()
) -> Pipeline:
    """Different step chains for different columns, the rest passed through, joined in one vector.

    Intermediate columns carry the name of their chain as a prefix.
    """
    stages = numeric_stages(numeric, "numeric") + categorical_stages(df, categorical, "categorical")
    parts = ["numeric", *[f"categorical__{c}_filled" for c in categorical], *passthrough]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=parts, outputCol="features", handleInvalid="keep")])


def spread_vector(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """A vector's slots as columns."""
    kept = [c for c in df.columns if c != vector]
    return df.withColumn("_slots", vector_to_array(vector)).select(
        *kept, *[F.col("_slots")[i].alias(n) for i, n in enumerate(names)]
    )


def unit_deviation(df: DataFrame, vector: str, output: str) -> DataFrame:
    """Divide by the standard deviation without centring."""
    return StandardScaler(inputCol=vector, outputCol=output, withMean=False, withStd=True).fit(df).transform(df)


def pca_stages(vector: str, k: int, output: str, centred: bool = True) -> list:
    """Principal components; centring first makes them scores around the mean."""
    if not centred:
        return [PCA(k=k, inputCol=vector, outputCol=output)]
    centre = f"{output}__centred"
    return [
        StandardScaler(inputCol=vector, outputCol=centre, withMean=True, withStd=False),
        PCA(k=k, inputCol=centre, outputCol=output),
    ]


def truncated_svd(df: DataFrame, columns: Sequence[str], k: int, output: str = "svd") -> DataFrame:
    """Project uncentred columns on the first k right singular vectors.

    The cross products are summed in blocks, whatever the number of columns; only a
    matrix as wide as the column list is decomposed on the driver. Each vector's
    largest weight is made positive.
    """
    products = gather(cross_products(df, columns))
    gram = products[()].raw() if products else np.zeros((len(columns), len(columns)))
    _, vectors = np.linalg.eigh(gram)
    values = F.array(*[F.col(c).cast("double") for c in columns])
    for place in range(k):
        axis = vectors[:, len(columns) - 1 - place]
        axis = axis * np.sign(axis[np.argmax(np.abs(axis))])
        weighted = F.zip_with(values, F.array(*[F.lit(float(w)) for w in axis]), lambda x, w: x * w)
        df = df.withColumn(f"{output}_{place + 1}", F.aggregate(weighted, F.lit(0.0), lambda a, v: a + v))
    return df


def side_by_side(inputs: Sequence[str], output: str = "features") -> VectorAssembler:
    """Join the results of several transformers that read the same columns."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output)


def expression_step(**columns: str) -> SQLTransformer:
    """A user function as a fitted-pipeline step: new columns from SQL expressions."""
    added = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return SQLTransformer(statement=f"SELECT *, {added} FROM __THIS__")


def formula(text: str) -> RFormula:
    """``label ~ .`` or ``label ~ a + b`` with text columns expanded; the first level in order is the reference."""
    return RFormula(formula=text, featuresCol="features", labelCol="label", stringIndexerOrderType="alphabetDesc")


def fit_chain(stages: Sequence, train: DataFrame) -> PipelineModel:
    return Pipeline(stages=list(stages)).fit(train)
