"""Cross products of many columns: partial sums per partition in blocks, merged in a tree.

One vectorised product per batch takes the place of one expression per pair of
columns, so a table of a thousand columns plans as fast as one of three. Sums are
centred: partial results are merged around their means, and a large mean costs no
digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of a block; a merge holds two blocks of this width at a time.
BLOCK = 256
#: Partial sums that a task holds before it passes them on, in numbers: 128 MB.
HELD = 1 << 24
#: Partial results of a key are first merged in so many groups, then together.
BRANCHES = 32


@dataclass(frozen=True)
class Products:
    """Number of rows, means and centred cross products of some columns."""

    n: float
    mean: np.ndarray
    gram: np.ndarray

    def __add__(self, other: Products) -> Products:
        n = self.n + other.n
        if not n:
            return self
        apart = other.mean - self.mean
        return Products(n, self.mean + apart * (other.n / n), self.gram + other.gram + np.outer(apart, apart) * (self.n * other.n / n))

    def __sub__(self, part: Products) -> Products:
        """The rows that are not in ``part``."""
        n = self.n - part.n
        if n <= 0:
            return Products(0.0, np.zeros_like(self.mean), np.zeros_like(self.gram))
        mean = (self.n * self.mean - part.n * part.mean) / n
        apart = part.mean - mean
        return Products(n, mean, self.gram - part.gram - np.outer(apart, apart) * (n * part.n / self.n))

    def raw(self) -> np.ndarray:
        """Cross products around zero."""
        return self.gram + self.n * np.outer(self.mean, self.mean)


def _of_batch(x: np.ndarray) -> Products:
    mean = x.mean(axis=0)
    apart = x - mean
    return Products(float(len(x)), mean, apart.T @ apart)


def cross_products(df: DataFrame, columns: Sequence[str] | str, by: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """Centred cross products of numeric ``columns`` (or of the array column of that name), per key.

    One row per key and pair of blocks (``bi`` <= ``bj``): n, mean_i, mean_j and
    products, row by row. Rows with a null in any column are left out; a null key is
    a key as any other. One scan; what is shuffled is as large as the blocks times
    the tasks, however many rows there are.
    """
    if isinstance(columns, str):
        values = F.col(columns).cast("array<double>")
        used = df.where(values.isNotNull() & ~F.exists(values, lambda v: v.isNull()))
    else:
        values = F.array(*[F.col(c).cast("double") for c in columns])
        used = df.dropna(subset=list(columns))
    keys = list(by)
    rows = used.select(*keys, values.alias("_values"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    fields = [*[f"`{k}` {kinds[k]}" for k in keys], "bi int", "bj int", "n double", "mean_i array<double>", "mean_j array<double>", "products array<double>"]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Products] = {}
        types = None

        def passed_on() -> Iterator[pa.RecordBatch]:
            for key, total in held.items():
                edges = range(0, len(total.mean), block)
                for i in edges:
                    for j in edges:
                        if i <= j:
                            a, b = slice(i, i + block), slice(j, j + block)
                            yield _row(key, types, i // block, j // block, total.n, total.mean[a], total.mean[b], total.gram[a, b])

        for batch in batches:
            if not batch.num_rows:
                continue
            types = types or [batch.schema.field(k) for k in keys]
            lists = batch.column("_values")
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            parts = {(): np.arange(len(x))}
            if keys:
                groups = batch.select(keys).to_pandas(integer_object_nulls=True).groupby(keys, dropna=False, sort=False).indices
                names = [batch.column(k) for k in keys]
                parts = {tuple(c[int(rows[0])].as_py() for c in names): rows for rows in groups.values()}
            for key, at in parts.items():
                new = _of_batch(x[at])
                held[key] = held[key] + new if key in held else new
            if len(held) * x.shape[1] ** 2 > HELD:
                yield from passed_on()
                held = {}
        if held:
            yield from passed_on()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spot, now, types = None, None, None
        for batch in batches:
            types = types or [batch.schema.field(k) for k in keys]
            for row in range(batch.num_rows):
                get = lambda name: batch.column(name)[row]  # noqa: B023, E731
                here = (tuple(get(k).as_py() for k in keys), get("bi").as_py(), get("bj").as_py())
                mean_i, mean_j = (np.array(get(c).values, dtype=float) for c in ("mean_i", "mean_j"))
                part = (get("n").as_py(), mean_i, mean_j, np.array(get("products").values, dtype=float).reshape(len(mean_i), len(mean_j)))
                if here != spot:
                    if spot is not None:
                        yield _row(spot[0], types, *spot[1:], *now)
                    spot, now = here, part
                else:
                    n = now[0] + part[0]
                    di, dj = part[1] - now[1], part[2] - now[2]
                    share = part[0] / n
                    now = (n, now[1] + di * share, now[2] + dj * share, now[3] + part[3] + np.outer(di, dj) * (now[0] * share))
        if spot is not None:
            yield _row(spot[0], types, *spot[1:], *now)

    schema = ", ".join(fields)
    partial = rows.mapInArrow(sums, schema).withColumn("_branch", F.spark_partition_id() % BRANCHES)
    spots = [*[F.col(f"`{k}`") for k in keys], F.col("bi"), F.col("bj")]
    tree = partial.repartition(*spots, "_branch").sortWithinPartitions(*spots, "_branch").drop("_branch").mapInArrow(merged, schema)
    return tree.repartition(*spots).sortWithinPartitions(*spots).mapInArrow(merged, schema)


def _row(key, types, bi, bj, n, mean_i, mean_j, products) -> pa.RecordBatch:
    numbers = pa.list_(pa.float64())
    arrays = [
        *[pa.array([k], f.type) for k, f in zip(key, types)], pa.array([bi], pa.int32()), pa.array([bj], pa.int32()), pa.array([n], pa.float64()),
        *[pa.array([np.ravel(v)], numbers) for v in (mean_i, mean_j, products)]]
    return pa.RecordBatch.from_arrays(arrays, names=[*[f.name for f in types], "bi", "bj", "n", "mean_i", "mean_j", "products"])


def gather(blocks: DataFrame, by: Sequence[str] = ()) -> dict[tuple, Products]:
    """The whole matrix of each key on the driver: columns squared numbers a key, whatever the number of rows."""
    table = blocks.toArrow()
    found: dict[tuple, list] = {}
    numbers = {c: table.column(c) for c in ("mean_i", "mean_j", "products")}
    plain = {c: table.column(c).to_pylist() for c in (*by, "bi", "bj", "n")}
    for at in range(table.num_rows):
        row = {c: plain[c][at] for c in ("bi", "bj", "n")} | {c: np.array(v[at].values, dtype=float) for c, v in numbers.items()}
        found.setdefault(tuple(plain[k][at] for k in by), []).append(row)
    out = {}
    for key, rows in found.items():
        means = {r["bi"]: r["mean_i"] for r in rows}
        starts = dict(zip(sorted(means), np.cumsum([0] + [len(means[b]) for b in sorted(means)])))
        width = sum(len(m) for m in means.values())
        mean, gram = np.concatenate([means[b] for b in sorted(means)]), np.zeros((width, width))
        for r in rows:
            i, j = starts[r["bi"]], starts[r["bj"]]
            part = r["products"].reshape(len(r["mean_i"]), len(r["mean_j"]))
            gram[i : i + part.shape[0], j : j + part.shape[1]] = part
            gram[j : j + part.shape[1], i : i + part.shape[0]] = part.T
        out[key] = Products(float(rows[0]["n"]), mean, gram)
    return out


def product_cells(blocks: DataFrame, by: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """The blocks as cells (key, n, i, j, covariance), ``i`` <= ``j``."""
    cell = F.posexplode("products").alias("_at", "_value")
    flat = blocks.select(*by, "n", "bi", "bj", F.size("mean_j").alias("_width"), cell)
    i = (F.col("bi") * block + F.floor(F.col("_at") / F.col("_width"))).cast("int")
    j = (F.col("bj") * block + F.col("_at") % F.col("_width")).cast("int")
    return flat.select(*by, "n", i.alias("i"), j.alias("j"), (F.col("_value") / F.col("n")).alias("covariance")).where("i <= j")


def correlation_cells(df: DataFrame, columns: Sequence[str], block: int = BLOCK) -> DataFrame:
    """Long matrix (i, j, corr) over complete rows; null where a column does not vary.

    Only the columns' variances pass through the driver; the cells are made where the blocks are.
    """
    from larkspur.session import checkpointed

    blocks = checkpointed(cross_products(df, columns, block=block))
    diagonal = F.expr("transform(sequence(0, size(mean_i) - 1), k -> products[k * size(mean_i) + k])")
    own = blocks.where("bi = bj").select("bi", "n", "mean_i", diagonal.alias("spread")).collect()
    # What rounding leaves of a column without spread is none.
    spread = {r["bi"]: np.where(np.array(r["spread"]) > r["n"] * (1e-13 * np.array(r["mean_i"])) ** 2, r["spread"], 0.0) for r in own}

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.select(["bi", "bj", "products"]).to_pylist():
                a, b = spread[r["bi"]], spread[r["bj"]]
                size = np.sqrt(np.outer(a, b))
                corr = np.divide(np.array(r["products"]).reshape(size.shape), size, out=np.full(size.shape, np.nan), where=size > 0)
                i, j = (x.ravel() for x in np.meshgrid(np.arange(len(a)) + r["bi"] * block, np.arange(len(b)) + r["bj"] * block, indexing="ij"))
                flat = corr.ravel()
                sides = [(i, j, flat)] if r["bi"] == r["bj"] else [(i, j, flat), (j, i, flat)]
                for x, y, c in sides:
                    c = np.where(x == y, np.where(np.isnan(c), np.nan, 1.0), c)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32()), pa.array(y, pa.int32()), pa.array(c, pa.float64(), mask=np.isnan(c))], names=["i", "j", "corr"])

    return blocks.mapInArrow(cells, "i int, j int, corr double")
