"""Digests of ordered rows per key, without holding a key's rows in memory."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A piece that is passed on holds about so many bytes; a single longer row is a piece by itself.
PIECE_BYTES = 1 << 20


def ordered_sha256(rows: DataFrame, key: str, order: Sequence[str], piece: str, separator: str) -> DataFrame:
    """Per key the SHA-256 (lowercase hex) of its pieces in order, joined by ``separator``: key, first, n, sha256.

    ``first`` is the value of ``order[0]`` in the key's first row, ``n`` the number of
    rows. A null key is a key as any other; ``piece`` holds text without nulls.

    Rows are range-partitioned by key and order, so tasks share the rows of a hot
    key; each joins runs of rows to pieces of bounded size. A digest itself has to
    see its bytes in order: the pieces of one key pass through one task, a piece at
    a time.
    """
    spot = ["_key", *[f"_o{i}" for i in range(len(order))]]
    named = rows.select(F.col(key).alias("_key"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], F.col(piece).alias("_piece"))
    kinds = {f.name: f.dataType.simpleString() for f in named.schema}
    gap = separator.encode()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, start, parts, size = None, None, [], 0
        out: list[tuple] = []
        schema = None

        def closed() -> tuple:
            return (key, *start, len(parts), gap.join(parts))

        for batch in batches:
            if schema is None:
                schema = pa.schema([*[batch.schema.field(c) for c in spot], ("_n", pa.int64()), ("_bytes", pa.binary())])
            columns = [batch.column(c).to_pylist() for c in (*spot, "_piece")]
            for now, *place, text in zip(*columns):
                data = text.encode("utf-8", "replace")
                if start is not None and (now != key or size + len(data) > PIECE_BYTES):
                    out.append(closed())
                    start, parts, size = None, [], 0
                if start is None:
                    key, start = now, place
                parts.append(data)
                size += len(data)
                if sum(len(o[-1]) for o in out[-64:]) > PIECE_BYTES or len(out) >= 5000:
                    yield _batch(out, schema)
                    out = []
        if start is not None:
            out.append(closed())
        if out:
            yield _batch(out, schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, key, first, n = None, None, None, 0
        out: list[tuple] = []
        schema = None
        for batch in batches:
            if schema is None:
                schema = pa.schema([batch.schema.field("_key"), pa.field("first", batch.schema.field("_o0").type), ("n", pa.int64()), ("sha256", pa.string())])
            for now, place, count, data in zip(*[batch.column(c).to_pylist() for c in ("_key", "_o0", "_n", "_bytes")]):
                if state is not None and now == key:
                    state.update(gap)
                else:
                    if state is not None:
                        out.append((key, first, n, state.hexdigest()))
                    state, key, first, n = hashlib.sha256(), now, place, 0
                state.update(data)
                n += count
            if len(out) >= 5000:
                yield _batch(out, schema)
                out = []
        if state is not None:
            out.append((key, first, n, state.hexdigest()))
        if out:
            yield _batch(out, schema)

    fields = ", ".join(f"{c} {kinds[c]}" for c in spot)
    pieces = named.repartitionByRange(*spot).sortWithinPartitions(*spot).mapInArrow(join, f"{fields}, _n long, _bytes binary")
    told = pieces.repartition("_key").sortWithinPartitions(*spot)
    out = told.mapInArrow(digest, f"_key {kinds['_key']}, first {kinds['_o0']}, n long, sha256 string")
    return out.withColumnRenamed("_key", key)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*rows), schema)], schema=schema)
