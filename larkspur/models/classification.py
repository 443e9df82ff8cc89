"""Classifiers, clusters, scoring and importance."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.classification import MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.models.features import assemble
from larkspur.operators.ranking import number_rows, top_n
from larkspur.session import checkpointed


def forest_classifier(trees: int = 100, depth: int = 10, seed: int = 123, **columns) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, **columns)


def neural_classifier(
    inputs: int, classes: int, hidden: Sequence[int] = (300, 400, 500), max_iter: int = 100, seed: int = 123, **columns
) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(layers=[inputs, *hidden, classes], maxIter=max_iter, seed=seed, **columns)


def importances(df: DataFrame, model, names: Sequence[str]) -> DataFrame:
    """(feature, importance) of a fitted tree ensemble."""
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def class_probability(vector: str = "probability", position: int = 1) -> Column:
    return vector_to_array(vector)[position]


def cut(probability: Column, threshold: float = 0.5) -> Column:
    return F.when(probability > threshold, 1).otherwise(0)


def best_prospects(scored: DataFrame, probability: str, keys: Sequence[str], n: int = 1000) -> DataFrame:
    """The n rows with the highest probability."""
    return top_n(scored, probability, n, keys)


def likely(scored: DataFrame, probability: str, threshold: float = 0.65) -> DataFrame:
    return scored.where(F.col(probability) > threshold)


def clusters(df: DataFrame, k: int, seed: int = 1, features: str = "features") -> tuple[object, DataFrame]:
    """(model, rows with ``prediction``)"""
    model = KMeans(k=k, seed=seed, featuresCol=features).fit(df)
    return model, model.transform(df)


def elbow(df: DataFrame, ks: Sequence[int], seed: int = 1, features: str = "features", silhouette: bool = False) -> DataFrame:
    """Training cost per number of clusters, with the silhouette if asked."""
    table = df.select(features).persist()
    rows = []
    try:
        for k in ks:
            model = KMeans(k=k, seed=seed, featuresCol=features).fit(table)
            score = None
            if silhouette:
                score = silhouette_score(model.transform(table), features)
            rows.append((int(k), float(model.summary.trainingCost), score))
    finally:
        table.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, cost double, silhouette double")


def silhouette_score(clustered: DataFrame, features: str = "features") -> float:
    return float(ClusteringEvaluator(metricName="silhouette", featuresCol=features).evaluate(clustered))


#: Steps of the walk in ``scattered``; see there.
WALK = 16


def scattered(place: Column, n: int, key: int, rounds: int = 6) -> Column:
    """A keyed one-to-one map of the positions 1 to ``n`` onto themselves.

    Positions are cells of a grid of a x b cells, a and b near the root of n. In
    turn, one coordinate is moved around by a hash of the other: each round can be
    undone, so no two positions meet. The fewer than a cells beyond n are walked
    over by applying the map again. A walk of ``WALK`` steps is enough for every
    n up to 256, and beyond that one fails with a chance under n ** -7; it then
    raises, rather than use a value twice.
    """
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    b = max(1, -(-n // a))

    def once(x: Column) -> Column:
        cell = F.struct((x % a).alias("l"), F.floor(x / a).cast("bigint").alias("r"))
        turns = F.array(*[F.lit(key * 1_000_003 + i) for i in range(rounds)])

        def turn(c: Column, k: Column) -> Column:
            left = F.pmod(c["l"] + F.pmod(F.xxhash64(c["r"], k), F.lit(a)), F.lit(a))
            right = F.pmod(c["r"] + F.pmod(F.xxhash64(left, k, F.lit(1)), F.lit(b)), F.lit(b))
            return F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))

        return F.aggregate(turns, cell, turn, lambda c: c["l"] + c["r"] * a)

    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), F.lit(-1).cast("bigint"),
        lambda x, i: F.when(i == 1, once(place.cast("bigint") - 1)).when(x >= n, once(x)).otherwise(x))
    return F.transform(F.array(walked), lambda x: F.when(x < n, x + 1).otherwise(
        F.raise_error(F.lit("no position found; use another key")).cast("bigint")))[0]


#: A task of ``shuffled_features`` sorts about so many values to their places.
CELLS = 500_000


def shuffled_features(placed: DataFrame, features: Sequence[str], n: int, seed: int = 123, place: str = "_place") -> DataFrame:
    """(place, _moved): per position the features' values of other rows, as array<double>, each feature moved by a key of its own.

    Every value is used exactly once. One shuffle, whatever the number of features,
    in tasks of at most about ``CELLS`` values, so that memory does not grow with the table.
    """
    cells = F.array(*[
        F.struct(scattered(F.col(place), n, seed + i).alias("at"), F.lit(i).alias("i"), F.col(f).cast("double").alias("v"))
        for i, f in enumerate(features)])
    spread = placed.select(F.explode(cells).alias("c")).select(F.col("c.at").alias(place), "c.i", "c.v")
    spread = spread.repartition(max(8, -(-n * len(features) // CELLS)), place)
    values = [F.max(F.when(F.col("i") == i, F.col("v"))) for i in range(len(features))]
    return spread.groupBy(place).agg(F.array(*values).alias("_moved"))


def shuffle_importance(
    df: DataFrame, model, features: Sequence[str], label: str, keys: Sequence[str], seed: int = 123
) -> DataFrame:
    """Accuracy lost when one feature's values are shuffled among the rows.

    ``model`` reads a vector column ``features``. The rows are numbered once in
    key order; a bijection of the positions per feature says where a value goes.
    One join brings all moved values to their rows, and one scan scores the rows
    as they are and with each feature replaced. Rows with a null feature are not
    scored. An empty table gives nulls.
    """
    placed = checkpointed(number_rows(df.select(*keys, *features, label), list(keys), name="_place"))
    own = [F.col(f).cast("double") for f in features]
    both = placed.join(shuffled_features(placed, features, placed.count(), seed), "_place")
    swaps = [[F.get("_moved", F.lit(i)) if j == i else c for j, c in enumerate(own)] for i in range(len(features))]
    cases = F.array(*[F.struct(F.lit(i).alias("i"), F.array(*v).alias("x")) for i, v in enumerate([own, *swaps])])
    rows = both.select(label, F.explode(cases).alias("c")).where(~F.exists("c.x", lambda v: v.isNull()))
    scored = model.transform(rows.select(label, "c.i", array_to_vector("c.x").alias("features")))
    found = {r["i"]: r["a"] for r in scored.groupBy("i").agg(F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("a")).collect()}
    base = found.get(0)
    table = [(f, float(base - found[i + 1]) if base is not None and i + 1 in found else None) for i, f in enumerate(features)]
    return df.sparkSession.createDataFrame(table, "feature string, accuracy_loss double")


def refit_on_best(
    train: DataFrame, test: DataFrame, fit: Callable[[DataFrame], object], ranked: DataFrame, label: str, best: Sequence[int],
    feature: str = "feature", weight: str = "accuracy_loss",
) -> DataFrame:
    """Models of the first few features only: (n_features, names, accuracy, error_rate) on ``test``, a row for each number in ``best``.

    ``ranked`` holds a row for each feature; the heaviest come first, ties by
    name. ``fit`` gets a table of ``features`` and ``label`` and returns a model.
    """
    order = [r[feature] for r in ranked.orderBy(F.col(weight).desc_nulls_last(), feature).select(feature).collect()]
    rows = []
    for n in best:
        names = order[:n]
        model = fit(assemble(train, names).select("features", label))
        hit = F.avg((F.col("prediction") == F.col(label)).cast("double"))
        accuracy = model.transform(assemble(test, names)).agg(hit).first()[0]
        rows.append((len(names), ",".join(names), accuracy, None if accuracy is None else 1 - accuracy))
    return train.sparkSession.createDataFrame(rows, "n_features int, names string, accuracy double, error_rate double")
