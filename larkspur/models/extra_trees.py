"""Extremely randomised trees for regression, grown level by level.

Every tree sees all rows. A node draws ``tries`` features and, for each, one
threshold between the least and the greatest value that the feature has in the
node; of these splits the one that lowers the squared error most is kept. A
level takes two scans: ranges per (tree, node, feature), then sums on both sides
of each drawn threshold. The rows are packed once in blocks of some thousand, so
a scan reads arrays. Both scans are summed per partition before they are
shuffled, so a shuffle carries the nodes of a level, not rows, and a hot value
costs no more than any other. The driver holds the trees: at most
``trees * 2 ** (depth + 1)`` nodes.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.session import checkpointed

BLOCKS = "n long, k int, total double, x binary, y binary"
#: A task holds so many numbers of its nodes before it hands them on.
HELD = 1 << 21
RANGES = "tree int, node int, feature int, low double, high double"
SUMS = "tree int, node int, feature int, n double, total double, n_left double, left double"


@dataclass
class Trees:
    """Nodes of each tree as in a heap: the children of i are 2i + 1 and 2i + 2. A leaf has feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def place(self, x: np.ndarray, tree: int, levels: int) -> np.ndarray:
        """The node that every row of ``x`` reaches after at most ``levels`` splits."""
        n, flat = len(x), x.ravel(order="F")
        feature, threshold = self.feature[tree], self.threshold[tree]
        column = np.maximum(feature, 0) * n
        at, row = np.zeros(n, dtype=np.int64), np.arange(n)
        for _ in range(levels):
            right = flat[column[at] + row] > threshold[at]
            at = np.where(feature[at] < 0, at, 2 * at + 1 + right)
        return at


@dataclass
class ExtraTreesModel:
    trees: Trees
    depth: int
    features: str = "features"

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Add the mean of the trees' answers; rows without features get null."""
        trees, depth = self.trees, self.depth

        @F.arrow_udf("double")
        def answer(values: pa.Array) -> pa.Array:
            known = values.is_valid().to_numpy(zero_copy_only=False)
            out = np.full(len(values), np.nan)
            if known.any():
                x = np.asfortranarray(values.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(known.sum(), -1))
                out[known] = np.mean([trees.value[t, trees.place(x, t, depth)] for t in range(len(trees.value))], axis=0)
            return pa.array(out, from_pandas=True)

        return df.withColumn(output, answer(F.when(F.col(self.features).isNotNull(), vector_to_array(self.features))))


def _packed(table: DataFrame) -> DataFrame:
    """The rows (x, y) in blocks, one for each Arrow batch: numbers of rows and features, sum of y, x feature by feature, and y."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x, y = batch.column("x").flatten().to_numpy(zero_copy_only=False), batch.column("y").to_numpy(zero_copy_only=False)
            if np.ptp(batch.column("x").value_lengths().to_numpy()):
                raise ValueError("the feature vectors differ in length")
            k = len(x) // n
            yield pa.RecordBatch.from_pydict({
                "n": pa.array([n], pa.int64()), "k": pa.array([k], pa.int32()), "total": pa.array([y.sum()], pa.float64()),
                "x": pa.array([x.reshape(n, k).T.tobytes()], pa.binary()), "y": pa.array([y.tobytes()], pa.binary())})

    return table.mapInArrow(run, BLOCKS)


def _unpacked(batches: Iterator[pa.RecordBatch], mean: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(x, y less ``mean``) of each block; x is in Fortran order."""
    for batch in batches:
        for n, k, x, y in zip(*[batch.column(c) for c in ("n", "k", "x", "y")]):
            shape = (k.as_py(), n.as_py())
            yield np.frombuffer(x.as_buffer(), dtype=float).reshape(shape).T, np.frombuffer(y.as_buffer(), dtype=float) - mean


def _open_rows(trees: Trees, t: int, x: np.ndarray, level: int, growing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, their nodes in the level) of the rows of ``x`` that lie in a node still growing."""
    first = 2**level - 1
    at = trees.place(x, t, level)
    rows = np.flatnonzero((at >= first) & growing[t, at])
    return rows, at[rows] - first


def _frame(schema: str, *columns: np.ndarray) -> pa.RecordBatch:
    """A batch with the columns of ``schema``, of which "int" ones have four bytes."""
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"int": pa.int32(), "double": pa.float64()}
    return pa.RecordBatch.from_pydict({name: pa.array(c, kinds[kind]) for (name, kind), c in zip(fields, columns)})


def _ranges(blocks: DataFrame, trees: Trees, level: int, growing: np.ndarray, mean: float) -> pd.DataFrame:
    """(tree, node, feature, low, high) of a level's growing nodes."""
    width = 2**level

    def handed_on(held: dict) -> Iterator[pa.RecordBatch]:
        for t, (seen, low, high) in held.items():
            nodes, k = np.flatnonzero(seen), low.shape[1]
            yield _frame(RANGES, np.full(len(nodes) * k, t), np.repeat(nodes, k), np.tile(np.arange(k), len(nodes)), low[nodes].ravel(), high[nodes].ravel())
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for x, _ in _unpacked(batches, mean):
            k = x.shape[1]
            for t in range(len(trees.value)):
                rows, node = _open_rows(trees, t, x, level, growing)
                if not len(rows):
                    continue
                if t not in held:
                    held[t] = np.zeros(width, dtype=bool), np.full((width, k), np.inf), np.full((width, k), -np.inf)
                seen, low, high = held[t]
                # Nodes of a level fit two bytes, which are sorted fastest.
                order = rows[np.argsort(node.astype(np.int16), kind="stable")]
                counts = np.bincount(node, minlength=width)
                nodes = np.flatnonzero(counts)
                starts = (np.cumsum(counts) - counts)[nodes]
                seen[nodes] = True
                for j in range(k):
                    values = x[:, j][order]
                    low[nodes, j] = np.minimum(low[nodes, j], np.minimum.reduceat(values, starts))
                    high[nodes, j] = np.maximum(high[nodes, j], np.maximum.reduceat(values, starts))
                if 2 * len(held) * width * k > HELD:
                    yield from handed_on(held)
        yield from handed_on(held)

    parts = blocks.mapInArrow(run, RANGES)
    return parts.groupBy("tree", "node", "feature").agg(F.min("low").alias("low"), F.max("high").alias("high")).toPandas()


def _draw(ranges: pd.DataFrame, tries: int, seed: int, level: int) -> dict[tuple[int, int], list[tuple[int, float]]]:
    """Per (tree, node) the drawn splits (feature, threshold); features that do not vary in a node are not drawn."""
    drawn = {}
    varying = ranges[ranges["low"] < ranges["high"]].sort_values(["tree", "node", "feature"])
    for (tree, node), rows in varying.groupby(["tree", "node"], sort=True):
        rng = random.Random(f"{seed}:{level}:{tree}:{node}")
        at = sorted(rng.sample(range(len(rows)), min(tries, len(rows))))
        cells = list(rows[["feature", "low", "high"]].itertuples(index=False))
        # Not the greatest value itself: a side would be empty.
        drawn[int(tree), int(node)] = [
            (int(cells[i].feature), min(cells[i].low + rng.random() * (cells[i].high - cells[i].low), float(np.nextafter(cells[i].high, cells[i].low)))) for i in at]
    return drawn


def _sums(blocks: DataFrame, trees: Trees, level: int, growing: np.ndarray, drawn: dict, mean: float) -> pd.DataFrame:
    """Row counts and target sums of every drawn split, in all and at or below the threshold."""
    slots = max(len(v) for v in drawn.values())
    width = 2**level
    feature = np.full((len(trees.value), width, slots), -1)
    cut = np.zeros((len(trees.value), width, slots))
    for (tree, node), splits in drawn.items():
        for s, (f, c) in enumerate(splits):
            feature[tree, node, s], cut[tree, node, s] = f, c

    def handed_on(held: dict) -> Iterator[pa.RecordBatch]:
        for t, (n, total, n_left, left) in held.items():
            node, slot = np.nonzero((n > 0)[:, None] & (feature[t] >= 0))
            yield _frame(SUMS, np.full(len(node), t), node, feature[t, node, slot], n[node], total[node], n_left[node, slot], left[node, slot])
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for x, y in _unpacked(batches, mean):
            flat = x.ravel(order="F")
            for t in range(len(trees.value)):
                rows, node = _open_rows(trees, t, x, level, growing)
                if not len(rows):
                    continue
                if t not in held:
                    held[t] = np.zeros(width), np.zeros(width), np.zeros((width, slots)), np.zeros((width, slots))
                n, total, n_left, left = held[t]
                weight = y[rows]
                n += np.bincount(node, minlength=width)
                total += np.bincount(node, weight, minlength=width)
                for s in range(slots):
                    f = feature[t, :, s]
                    below = (f >= 0)[node] & (flat[(np.maximum(f, 0) * len(x))[node] + rows] <= cut[t, :, s][node])
                    side = 2 * node + below
                    n_left[:, s] += np.bincount(side, minlength=2 * width)[1::2]
                    left[:, s] += np.bincount(side, weight, minlength=2 * width)[1::2]
                if 2 * len(held) * width * (slots + 1) > HELD:
                    yield from handed_on(held)
        yield from handed_on(held)

    parts = blocks.mapInArrow(run, SUMS)
    return parts.groupBy("tree", "node", "feature").agg(*[F.sum(c).alias(c) for c in ("n", "total", "n_left", "left")]).toPandas()


def extra_trees(
    train: DataFrame, trees: int = 100, depth: int = 10, tries: int | None = None, min_rows: int = 2, seed: int = 123,
    features: str = "features", label: str = "label",
) -> ExtraTreesModel:
    """Fit on a vector column and a numeric label; rows with a null in either are left out.

    ``tries`` features are drawn per node (all by default), nodes with fewer than
    ``min_rows`` rows are leaves. The draws depend on the seed and a node's place
    only, not on how the rows are laid out. No rows give no model.
    """
    blocks = checkpointed(_packed(train.where(F.col(features).isNotNull() & F.col(label).isNotNull()).select(
        vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))))
    start = blocks.agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("k").alias("k")).first()
    if not start["n"]:
        raise ValueError("no rows to fit")
    if not 0 <= depth <= 16:
        raise ValueError("depth lies between 0 and 16: nodes are kept for whole levels")
    size = 2 ** (depth + 1) - 1
    model = Trees(np.full((trees, size), -1), np.zeros((trees, size)), np.zeros((trees, size)))
    # Sums of the target are taken about its mean, which keeps their digits.
    mean = start["total"] / start["n"]
    growing = np.zeros((trees, size), dtype=bool)
    growing[:, 0] = start["n"] >= min_rows
    for level in range(depth):
        if not growing.any():
            break
        drawn = _draw(_ranges(blocks, model, level, growing, mean), tries or int(start["k"]), seed, level)
        if not drawn:
            break
        sums = _sums(blocks, model, level, growing, drawn, mean)
        growing = _split(model, sums, drawn, level, min_rows)
    model.value += mean
    return ExtraTreesModel(model, depth, features)


def _split(model: Trees, sums: pd.DataFrame, drawn: dict, level: int, min_rows: int) -> np.ndarray:
    """Keep the best drawn split of every node, and say which children may grow."""
    n_right, right = sums["n"] - sums["n_left"], sums["total"] - sums["left"]
    gain = sums["left"] ** 2 / sums["n_left"] + right**2 / n_right - sums["total"] ** 2 / sums["n"]
    found = sums.assign(n_right=n_right, right=right, gain=gain)
    found = found[(found["n_left"] > 0) & (n_right > 0) & (gain > 1e-12 * (1 + sums["total"] ** 2 / sums["n"]))]
    best = found.sort_values(["gain", "feature"], ascending=[False, True]).drop_duplicates(["tree", "node"])
    growing = np.zeros(model.feature.shape, dtype=bool)
    first = 2**level - 1
    for r in best.itertuples(index=False):
        at, threshold = first + r.node, dict(drawn[r.tree, r.node])[r.feature]
        model.feature[r.tree, at], model.threshold[r.tree, at] = r.feature, threshold
        for child, n, total in ((2 * at + 1, r.n_left, r.left), (2 * at + 2, r.n_right, r.right)):
            model.value[r.tree, child] = total / n
            growing[r.tree, child] = n >= min_rows
    return growing


def splits(spark, model: ExtraTreesModel, names: Sequence[str]) -> DataFrame:
    """(tree, node, feature, threshold, value) of every node that a row can reach; a leaf has no feature."""
    trees, rows = model.trees, []
    for t in range(len(trees.value)):
        reach = [0]
        for at in reach:
            f = int(trees.feature[t, at])
            rows.append((t, at, names[f] if f >= 0 else None, float(trees.threshold[t, at]) if f >= 0 else None, float(trees.value[t, at])))
            if f >= 0:
                reach += [2 * at + 1, 2 * at + 2]
    return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, value double")
