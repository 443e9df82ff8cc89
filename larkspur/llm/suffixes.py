"""Operator 4, suffix-array dedup: remove every byte that a long repeated string covers.

Every window of ``length`` bytes has an anchor, which its bytes alone determine.
Windows with equal bytes have equal anchors at equal places, so only what lies
around equal anchors is compared. Most of it is equal or different as a whole and
is settled by digests. The rest goes, in bounded shards, through a suffix array:
its Burrows-Wheeler transform is searched backwards, breadth first, which finds the
common prefixes of neighbouring suffixes by increasing length, and stops at
``length``. Suffixes that are not parted by then begin with the same string.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.bagminhash import GOLDEN, mix
from larkspur.llm.common import bitmap_of, cut, llm_query, maybe_in, table
from larkspur.session import scratch_path

GRAM = 16
PLACE = (1 << 24) - 1
PIECE = 1 << 23


@dataclass(frozen=True)
class Settings:
    """``blocks``: how finely the windows of one anchor are parted, coarse first; a group of more than
    ``group`` different strings is parted by the next, until at 1 a string is a single window.
    ``shard``: bytes of one suffix array."""

    length: int = 400
    blocks: tuple[int, ...] = (32, 8, 1)
    group: int = 2000
    shard: int = 1_500_000


SETTINGS = Settings()


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every window of ``width`` values."""
    size = -(-len(x) // width) * width
    padded = np.full(size, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(x) - width + 1
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def anchors_of(data: bytes, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: first and last window, the anchor's place and hash, and a digest of the run's bytes.

    The anchor of a window is its 16-gram of least hash, the last of equal ones.
    """
    parts: list[tuple[np.ndarray, ...]] = [tuple(np.zeros(0, np.int64) for _ in range(5))]
    view = memoryview(data)
    for start in range(0, len(data) - length + 1, PIECE):
        part = view[start : start + PIECE + length - 1]
        eight = np.ndarray((len(part) - 7,), "<u8", part, strides=(1,))
        h = mix(mix(eight[:-8] * GOLDEN) + eight[8:])
        key = (h & ~np.uint64(PLACE)) | (np.uint64(PLACE) - np.arange(len(h), dtype=np.uint64))
        place = PLACE - (sliding_min(key, length - GRAM + 1) & np.uint64(PLACE)).astype(np.int64)
        at = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        stop = np.r_[at[1:], len(place)] - 1
        digest = [xxhash.xxh3_64_intdigest(part[a : b + length]) for a, b in zip(at.tolist(), stop.tolist())]
        parts.append((at + start, stop + start, place[at] + start, h[place[at]].view(np.int64), np.array(digest, np.uint64).view(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*parts))


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols (at least), by prefix doubling; symbols are below 512."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(7, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = (key << 9) | padded[k : k + n]
    done = 7
    while True:
        order = np.argsort(key)
        rank = np.empty(n, np.int64)
        ahead = key[order]
        rank[order] = np.cumsum(np.r_[True, ahead[1:] != ahead[:-1]])
        if done >= depth or rank[order[-1]] == n:
            return order
        key = rank * (n + 2)
        key[: n - done] += rank[done:] if done < n else 0
        done *= 2


def repeated_prefixes(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order, and where it parts: whether each suffix differs from the one before within ``length`` symbols.

    Interval expansion: when a border is found at common-prefix length k, the
    interval that begins there is extended backwards by every symbol that the
    transform has in it. The first suffix of each extended interval parts from the
    one before at length k + 1, unless it was found to part earlier. Intervals are
    taken breadth first, so lengths only grow, and the search ends at ``length``.
    """
    n = len(symbols)
    order = suffix_order(symbols, length + 1)
    before = symbols[order - 1]  # the transform: the symbol before each suffix
    sources = np.argsort(before, kind="stable")
    extended = np.empty(n, np.int64)  # the place of each suffix with its symbol put before it
    extended[sources] = np.arange(n)
    earlier = np.full(n, -1, np.int64)  # the last place before with the same symbol in the transform
    same = before[sources[1:]] == before[sources[:-1]]
    earlier[sources[1:][same]] = sources[:-1][same]
    known = np.zeros(n + 1, dtype=bool)
    known[n] = True
    used = symbols[order]
    new = np.flatnonzero(np.r_[True, used[1:] != used[:-1]])
    known[new] = True
    for _ in range(length - 1):
        found = []
        sizes = _interval_ends(known, new) - new
        cuts = np.searchsorted(np.cumsum(sizes), np.arange(0, sizes.sum(), 4_000_000), side="right")
        for at, stop in zip(cuts, np.r_[cuts[1:], len(new)]):
            p, size = new[at:stop], sizes[at:stop]
            start = np.repeat(p, size)
            inside = start + np.arange(len(start)) - np.repeat(np.cumsum(size) - size, size)
            last = earlier[inside]
            found.append(extended[inside[(last < start) & (last >= 0)]])
        q = np.concatenate(found)
        new = np.unique(q[~known[q]])
        if not len(new):
            break
        known[new] = True
    return order, known[:n]


def _interval_ends(known: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The next border after each of ``starts``."""
    if len(starts) * 64 < len(known):
        ends = starts + 1
        far = np.flatnonzero(~known[ends])
        for _ in range(64):
            if not len(far):
                return ends
            ends[far] += 1
            far = far[~known[ends[far]]]
    borders = np.flatnonzero(known)
    return borders[np.searchsorted(borders, starts, side="right")]


def repeated_starts(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string the places where a string of ``length`` bytes begins that also begins elsewhere in ``strings``."""
    sizes = np.array([len(s) for s in strings], np.int64)
    symbols = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int16) + 1
    ends = np.cumsum(sizes + 1) - 1
    symbols[ends] = 0  # parts the strings
    order, parted = repeated_prefixes(symbols, length)
    twin = ~parted  # same prefix as the suffix before
    twin[:-1] |= ~parted[1:]
    hit = np.zeros(len(symbols), dtype=bool)
    hit[order[twin]] = True
    out = []
    for size, end in zip(sizes.tolist(), ends.tolist()):
        out.append(np.flatnonzero(hit[end - size : end - length + 1]) if size >= length else np.zeros(0, np.int64))
    return out


def _runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of consecutive numbers: first and last."""
    cuts = np.flatnonzero(np.diff(starts) != 1)
    return starts[np.r_[0, cuts + 1]], starts[np.r_[cuts, len(starts) - 1]]


def merged(spans: np.ndarray) -> np.ndarray:
    """The union of spans (start, end) as sorted spans that neither overlap nor touch."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.r_[True, spans[1:, 0] > reach[:-1]]
    return np.column_stack([spans[new, 0], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(spans) - 1]]])


def _named(docs: DataFrame, key: str) -> Column:
    """``key`` with a value for null, so that joins find it; a key that has this value is told apart by the text, or has the same spans."""
    return F.coalesce(F.col(key), F.lit("" if docs.schema[key].dataType.typeName() == "string" else 0).cast(docs.schema[key].dataType))


def _anchor_rows(rows: DataFrame, s: Settings) -> DataFrame:
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [anchors_of(t.encode(), s.length) for t in batch["text"]]
            times = [len(f[0]) for f in found]
            columns = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 5
            yield pd.DataFrame({
                "doc": np.repeat(batch["doc"].to_numpy(), times), "row": np.repeat(batch["row"].to_numpy(), times),
                **dict(zip(("first", "last", "place", "anchor", "digest"), columns))})

    return rows.mapInPandas(run, f"doc {kind}, row long, first int, last int, place int, anchor long, digest long")


def _with_texts(rows: DataFrame, wanted: DataFrame, columns: list[str]) -> DataFrame:
    """The documents that ``wanted`` (doc, row, ...) names, once each, with their wanted rows as an array."""
    lists = wanted.groupBy("doc", "row").agg(F.collect_list(F.struct(*columns)).alias("wanted"))
    some = rows.where(maybe_in(bitmap_of(wanted.select("row").distinct()), F.col("row"))).dropDuplicates(["doc", "row"])
    return some.join(lists, ["doc", "row"])


def _blocks(rows: DataFrame, wanted: DataFrame, size: int, s: Settings) -> DataFrame:
    """Part runs of windows into blocks of ``size`` places relative to the anchor.

    All windows of a block hold its core, so only blocks with one core can have a
    window in common. Columns doc, row, place, first, last, core and core2 (128 bits), content.
    """
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, row, text, runs in zip(batch["doc"], batch["row"], batch["text"], batch["wanted"]):
                view = memoryview(text.encode())
                for r in runs:
                    first, last, place = r["first"], r["last"], r["place"]
                    for b in range((first - place) // size, (last - place) // size + 1):
                        low = place + b * size
                        a, z = max(first, low), min(last, low + size - 1)
                        core = xxhash.xxh3_128_intdigest(view[low + size - 1 : low + s.length], b & 0xFFFF)
                        out.append((doc, row, place, a, z, _signed(core >> 64), _signed(core ^ r["anchor"]),
                                    _signed(xxhash.xxh3_64_intdigest(view[a : z + s.length], a - low))))
            yield pd.DataFrame(out, columns=["doc", "row", "place", "first", "last", "core", "core2", "content"])

    parted = _with_texts(rows, wanted, ["first", "last", "place", "anchor"])
    return parted.mapInPandas(run, f"doc {kind}, row long, place int, first int, last int, core long, core2 long, content long")


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def _sharded(rows: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """Suffix arrays over bounded shards of strings: spans (doc, row, start, stop) that repeat."""
    kind = rows.schema["doc"].dataType.simpleString()

    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, row, text, runs in zip(batch["doc"], batch["row"], batch["text"], batch["wanted"]):
                data = text.encode()
                out += [(doc, row, r["first"], r["core"], r["core2"], data[r["first"] : r["last"] + s.length]) for r in runs]
            yield pd.DataFrame(out, columns=["doc", "row", "first", "core", "core2", "data"])

    def solve(part: list[pd.DataFrame]) -> pd.DataFrame:
        whole = pd.concat(part)
        out = []
        for doc, row, first, starts in zip(whole["doc"], whole["row"], whole["first"], repeated_starts(whole["data"].tolist(), s.length)):
            if len(starts):
                a, z = _runs(starts)
                out += [(doc, row, first + x, first + y + s.length) for x, y in zip(a.tolist(), z.tolist())]
        return pd.DataFrame(out, columns=["doc", "row", "start", "stop"])

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:  # sorted by core: a shard ends only between two cores
            keys = batch[["core", "core2"]].to_numpy()
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            for a, z in zip(starts, np.r_[starts[1:], len(batch)]):
                group = batch.iloc[a:z]
                if held and size >= s.shard and (held[-1][["core", "core2"]].to_numpy()[-1] != keys[a]).any():
                    yield solve(held)
                    held, size = [], 0
                held.append(group)
                size += int(group["data"].map(len).sum())
        if held:
            yield solve(held)

    total = wanted.agg(F.coalesce(F.sum((F.col("last") - F.col("first") + s.length).cast("long")), F.lit(0))).first()[0]
    parts = max(1, -(-total // s.shard))
    texts = _with_texts(rows, wanted, ["first", "last", "core", "core2"])
    named = texts.mapInPandas(strings, f"doc {kind}, row long, first int, core long, core2 long, data binary")
    return named.repartition(parts, "core", "core2").sortWithinPartitions("core", "core2").mapInPandas(
        shards, f"doc {kind}, row long, start long, stop long")


def repeated_spans(docs: DataFrame, key: str, s: Settings = SETTINGS) -> DataFrame:
    """Spans (doc, row, start, stop) of bytes that a repeated window covers; spans may overlap.

    ``row`` is a hash of the text: rows that repeat a key and a text share their
    spans, and count as places of their own. A null key is named by ``_named``.
    """
    spark = docs.sparkSession
    rows = docs.select(_named(docs, key).alias("doc"), F.xxhash64("text").alias("row"), "text").where(F.octet_length("text") >= s.length)
    path = scratch_path(spark, "anchors")
    _anchor_rows(rows, s).write.parquet(path)
    runs = spark.read.parquet(path)

    # Anchors that are found twice; "mixed": not always with the same bytes around.
    twice = runs.groupBy("anchor").agg(F.count("*").alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high")).where("n > 1")
    twice = cut(twice.select("anchor", (F.col("low") < F.col("high")).alias("mixed")))
    around = runs.where(maybe_in(bitmap_of(twice.select("anchor")), F.col("anchor")))
    same = around.groupBy("anchor", "digest").agg(
        F.count("*").alias("n"), F.min(F.struct("doc", "row", "first", "last", "place")).alias("one")).join(twice, "anchor")
    same = cut(same.select("anchor", "digest", "n", "mixed", "one.*"))
    many = same.where("n > 1").select("anchor", "digest")
    at = around.where(maybe_in(bitmap_of(many.select("digest")), F.col("digest"))).join(many, ["anchor", "digest"])
    start, stop = F.col("first").cast("long").alias("start"), (F.col("last") + s.length).cast("long").alias("stop")
    spans = [at.select("doc", "row", start, stop)]

    left = same.where("mixed").select("doc", "row", "first", "last", "place", "anchor")
    for size in s.blocks:
        parted = scratch_path(spark, f"blocks{size}")
        _blocks(rows, left, size, s).write.parquet(parted)
        blocks = spark.read.parquet(parted)
        contents = blocks.groupBy("core", "core2", "content").agg(
            F.count("*").alias("n"), F.min(F.struct("doc", "row", "first", "last", "place")).alias("one"))
        cores = contents.groupBy("core", "core2").agg(F.count("*").alias("strings"))
        contents = cut(contents.join(cores, ["core", "core2"]).where("n > 1 OR strings > 1"))
        full = contents.where("n > 1").select("core", "core2", "content")
        settled = blocks.where(maybe_in(bitmap_of(full.select("content")), F.col("content"))).join(full, ["core", "core2", "content"])
        spans.append(settled.select("doc", "row", start, stop))
        open_ = contents.where("strings > 1").select("strings", "core", "core2", "one.*")
        spans.append(_sharded(rows, open_.where(F.col("strings") <= s.group), s))
        left = open_.where(F.col("strings") > s.group).select("doc", "row", "first", "last", "place", F.col("core2").alias("anchor"))
        if left.isEmpty():
            break
    found = spans[0]
    for more in spans[1:]:
        found = found.unionByName(more)
    return found


def remove_repeats(docs: DataFrame, key: str = "doc_id", s: Settings = SETTINGS) -> DataFrame:
    """Remove the bytes of every string of ``length`` bytes that starts at two places or more.

    ``docs`` needs ``key`` and text; returns key, n_bytes, spans (array of start
    and stop, zero-based, of the maximal removed runs) and kept (binary: what is
    left, joined). Texts are taken as UTF-8 bytes, null as empty; matches never
    cross texts; all strings are judged on the input. A cut may part a character,
    so ``kept`` is binary. Repeated rows are two documents: each loses what the
    other holds. Short and empty texts lose nothing. Extra columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    lists = repeated_spans(docs, key, s).groupBy("doc", "row").agg(F.collect_list(F.struct("start", "stop")).alias("found"))
    lists = cut(lists)
    rows = docs.select(F.col(key).alias("doc"), _named(docs, key).alias("name"), F.xxhash64("text").alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    touched = maybe_in(bitmap_of(lists.select("row").distinct()), F.col("row"))
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    plain = lambda df: df.select(F.col("doc").alias(key), F.octet_length("text").cast("long").alias("n_bytes"), none.alias("spans"), F.encode("text", "utf-8").alias("kept"))

    def cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, found in zip(batch["doc"], batch["text"], batch["found"]):
                data = text.encode()
                gone = merged(np.array([(f["start"], f["stop"]) for f in found], np.int64))
                edges = np.concatenate([[0], gone.ravel(), [len(data)]]).tolist()
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((doc, len(data), [{"start": a, "stop": b} for a, b in gone.tolist()], kept))
            yield pd.DataFrame(out, columns=[key, "n_bytes", "spans", "kept"])

    schema = f"`{key}` {kind}, n_bytes long, spans array<struct<start:bigint,stop:bigint>>, kept binary"
    match = (F.col("name") == F.col("_doc")) & (F.col("row") == F.col("_row"))
    named = lists.select(F.col("doc").alias("_doc"), F.col("row").alias("_row"), "found")
    some = rows.where(touched).join(named, match, "left")
    changed = some.where("found IS NOT NULL").select("doc", "text", "found").mapInPandas(cut_out, schema)
    return plain(rows.where(~touched)).unionByName(plain(some.where("found IS NULL"))).unionByName(changed)


@llm_query("op4_suffix_array_dedup")
def op4_suffix_array_dedup(spark, sf_dir):
    """The contract's columns, and ``repeated``: whether the document loses a passage of ``length`` bytes that is found again."""
    cut_down = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])
    return cut_down.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        (F.size("spans") > 0).alias("repeated"))
