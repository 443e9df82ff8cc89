"""Operator 10, near-duplicate documents by BagMinHash.

A document is the multiset of its five-word shingles. BagMinHash draws, for each
shingle, the points of a Poisson process over (time, weight, component); a
document sees the points below its weight, and each component of its signature is
the first point it sees there. Two documents share a component with a probability
that is exactly their weighted Jaccard similarity. Signatures are cut into bands,
documents that share a band are candidates, and the overlap of the multisets
decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import SKETCH, bitmap_of, components, cut, llm_query, maybe_in, open_pairs, star_pairs, table, without

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
WORDS = 400_000


@dataclass(frozen=True)
class Settings:
    """``bands`` times ``rows`` components: at similarity 0.8 a pair is missed once in 14,000."""

    width: int = 5
    similarity: float = 0.8
    bands: int = 24
    rows: int = 5

    @property
    def size(self) -> int:
        return self.bands * self.rows


SETTINGS = Settings()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bags(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shingle multisets of texts: owner (place in ``texts``), hash and count, ordered by owner, then hash.

    Words are what white space parts. A text of fewer than ``width`` words has one
    shingle, all its words; a text without words has none.
    """
    words, counts = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = text.split()
        counts[i] = len(own)
        words += own
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes, unique = pd.factorize(np.array(words, dtype=object))
    hashed = pd.util.hash_array(np.asarray(unique, dtype=object), categorize=False)[codes]
    first = np.cumsum(counts) - counts
    shingles = np.where(counts == 0, 0, np.maximum(1, counts - width + 1))
    owner = np.repeat(np.arange(len(texts)), shingles)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles) + np.repeat(first, shingles)
    length = np.minimum(counts, width)[owner]
    h = length.astype(np.uint64)
    for k in range(width):
        there = k < length
        h[there] = mix(h[there] + hashed[start[there] + k] * GOLDEN)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]
    at = np.flatnonzero(new)
    return owner[at], h[at], np.diff(np.r_[at, len(h)])


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, docs: int, size: int) -> np.ndarray:
    """BagMinHash signatures, docs x size, as the times of the first points; infinite for empty bags.

    The weights of an element are levels 1, 2, ...; level cells (0,1], (1,2],
    (2,4], (4,8], ... each have a Poisson process of their own, with a rate of the
    cell's length, whose points lie on one level of the cell. So two documents see
    the same points up to the lesser of their weights. Points come in order of
    time and stop at a limit per document by which its components are almost
    surely filled; where one is not, the limit is doubled.
    """
    result = np.full((docs, size), np.inf)
    total = np.bincount(owner, weight, minlength=docs)
    limit = (np.log(size) + 4) / np.maximum(total, 1)
    cells = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    doc, elem, top = np.repeat(owner, cells), np.repeat(element, cells), np.repeat(weight, cells)
    cell = np.arange(len(doc)) - np.repeat(np.cumsum(cells) - cells, cells)
    length = np.where(cell < 2, 1, 1 << np.maximum(cell - 1, 0))
    below = np.where(cell == 0, 0, 1 << np.maximum(cell - 1, 0))
    seed = mix(elem + (cell.astype(np.uint64) + np.uint64(1)) * GOLDEN)
    wanted = total > 0
    while wanted.any():
        live = np.flatnonzero(wanted[doc])
        time = np.zeros(len(live))
        result[wanted] = np.inf
        draw = np.zeros(1, np.uint64)
        while len(live):
            draw += GOLDEN
            r = mix(seed[live] + draw)
            s = mix(r + GOLDEN)
            time = time - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (size * length[live])
            early = time < limit[doc[live]]
            live, time, s = live[early], time[early], s[early]
            level = below[live] + 1 + ((s >> np.uint64(32)) % length[live].astype(np.uint64)).astype(np.int64)
            seen = level <= top[live]
            place = ((s & np.uint64(0xFFFFFFFF)) % np.uint64(size)).astype(np.int64)
            np.minimum.at(result.reshape(-1), doc[live[seen]] * size + place[seen], time[seen])
        wanted = wanted & ~np.isfinite(result).all(axis=1)
        limit = np.where(wanted, 2 * limit, limit)
    return result


def _portions(texts: list[str]) -> Iterator[slice]:
    """Slices of about ``WORDS`` words (a word taken as six characters)."""
    at = 0
    while at < len(texts):
        stop, chars = at, 0
        while stop < len(texts) and (stop == at or chars + len(texts[stop]) <= 6 * WORDS):
            chars += len(texts[stop])
            stop += 1
        yield slice(at, stop)
        at = stop


def band_hashes(texts: list[str], s: Settings) -> tuple[list[list[int] | None], list[int]]:
    """The hashes of each text's bands (None for a text without words), and the sizes of the multisets."""
    out: list[list[int] | None] = []
    sizes: list[int] = []
    for part in _portions(texts):
        some = texts[part]
        owner, element, weight = bags(some, s.width)
        signature = signatures(owner, element, weight, len(some), s.size)
        bits = signature.view(np.uint64).reshape(len(some), s.bands, s.rows)
        h = np.broadcast_to(np.arange(1, s.bands + 1, dtype=np.uint64), bits.shape[:2]).copy()
        for k in range(s.rows):
            h = mix(h * GOLDEN + bits[:, :, k])
        full = np.isfinite(signature).all(axis=1)
        out += [row if ok else None for row, ok in zip(h.view(np.int64).tolist(), full)]
        sizes += np.bincount(owner, weight, minlength=len(some)).astype(np.int64).tolist()
    return out, sizes


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """Size of the intersection of two bags (sorted hashes, counts)."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    if not len(a[0]):
        return 0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][at] == a[0]
    return int(np.minimum(a[1][same], b[1][at[same]]).sum())


def compared(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """``pairs`` (a, b) with the overlap of their multisets, and whether they are similar; ``texts``: (id, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            left, right = batch["text_a"].tolist(), batch["text_b"].tolist()
            shared, both = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for part in _portions(left):
                codes, unique = pd.factorize(np.array(left[part] + right[part], dtype=object))
                owner, h, n = bags(list(unique), s.width)
                size = np.bincount(owner, n, minlength=len(unique)).astype(np.int64)
                cuts = np.searchsorted(owner, np.arange(len(unique) + 1))
                bag = [(h[x:y], n[x:y]) for x, y in zip(cuts, cuts[1:])]
                x, y = codes[: len(codes) // 2], codes[len(codes) // 2 :]
                shared[part] = [overlap(bag[i], bag[j]) for i, j in zip(x, y)]
                both[part] = size[x] + size[y]
            similar = (shared > 0) & (shared >= s.similarity * (both - shared))
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "overlap": shared, "similar": similar})

    held = lambda side: texts.where(maybe_in(bitmap_of(pairs.select(side)), F.col("id"))).select(F.col("id").alias(side), F.col("text").alias(f"text_{side}"))
    kind = pairs.schema["a"].dataType.simpleString()
    return pairs.join(held("a"), "a").join(held("b"), "b").select("a", "b", "text_a", "text_b").mapInPandas(
        run, f"a {kind}, b {kind}, overlap long, similar boolean")


def levels(owner: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bags as sets: an element with count n becomes n elements, so that sets share as many as bags."""
    each = np.repeat(np.arange(len(n)), n)
    level = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
    return owner[each], mix(h[each] + level.astype(np.uint64) * GOLDEN)


def outlines(texts: DataFrame, s: Settings) -> DataFrame:
    """(id, size, sketch) of each multiset of ``texts`` (id, text): its size and its parity sketch, as in ``parity_sketch``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            whole, ids = batch["text"].tolist(), batch["id"].to_numpy()
            for part in _portions(whole):
                docs = len(whole[part])
                owner, h = levels(*bags(whole[part], s.width))
                odd = np.bincount(owner * 64 * SKETCH + (h % np.uint64(64 * SKETCH)).astype(np.int64), minlength=docs * 64 * SKETCH) & 1
                words = np.packbits(odd.astype(np.uint8).reshape(docs, -1), axis=1, bitorder="little").view(np.int64)
                yield pd.DataFrame({"id": ids[part], "size": np.bincount(owner, minlength=docs), "sketch": words.tolist()})

    return texts.mapInPandas(run, f"id {texts.schema['id'].dataType.simpleString()}, size long, sketch array<long>")


def bag_sets(texts: DataFrame, s: Settings) -> DataFrame:
    """(id, set) of each multiset of ``texts`` (id, text), as a set of hashes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            whole, ids = batch["text"].tolist(), batch["id"].to_numpy()
            for part in _portions(whole):
                owner, h = levels(*bags(whole[part], s.width))
                cuts = np.searchsorted(owner, np.arange(1, len(whole[part])))
                yield pd.DataFrame({"id": ids[part], "set": [x.tolist() for x in np.split(h.view(np.int64), cuts)]})

    return texts.mapInPandas(run, f"id {texts.schema['id'].dataType.simpleString()}, set array<long>")


def near_duplicates(docs: DataFrame, key: str = "doc_id", s: Settings = SETTINGS) -> DataFrame:
    """Group near-duplicates: key, group_id (least key of the group), group_size, kept.

    ``docs`` needs ``key`` (an integer) and text; other columns are not read. Kept
    is the document with the least key of its group. Equal texts, empty ones too,
    are one class from the start, and only one text of each class goes on. A null
    text, a row with a null key and a document without a partner are groups of
    their own. Texts of fewer than five words are near-duplicates only if all
    words are the same. Rows that repeat a key and text are one document and give
    one row; a key with several texts gives one row, in the least of their groups.
    """
    kind = docs.schema[key].dataType.simpleString()

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bands, sizes = band_hashes(batch["text"].tolist(), s)
            yield pd.DataFrame({"id": batch["id"], "digest": batch["digest"], "bands": bands, "size": sizes})

    rows = docs.where(F.col(key).isNotNull() & F.col("text").isNotNull()).select(F.col(key).alias("id"), "text")
    signed = rows.select("id", "text", F.sha2("text", 256).alias("digest")).mapInPandas(sign, f"id {kind}, digest string, bands array<bigint>, size long")
    signed = cut(signed.select("id", F.unhex("digest").alias("digest"), "bands", "size"))
    classes = cut(signed.groupBy("digest").agg(F.min(F.struct("id", "bands", "size")).alias("c")).select("digest", "c.*"))
    members = classes.where("bands IS NOT NULL").select(F.explode("bands").alias("bucket"), "id")
    tested = cut(compared(cut(star_pairs(members)), rows, s).groupBy("a", "b").agg(F.max("overlap").alias("overlap"), F.max("similar").alias("similar")))
    edges = tested.where("similar").select("a", "b")
    roots = cut(components(edges))
    # What the stars leave open: exact, and linear but for texts that differ and can still be similar.

    def texts_of(ids: DataFrame) -> DataFrame:
        return rows.where(maybe_in(bitmap_of(ids), F.col("id"))).join(ids, "id", "left_semi").dropDuplicates(["id", "text"])

    def sizes_of(ids: DataFrame) -> DataFrame:
        # What a key with several texts shares with the least member is not known for each of them.
        several = classes.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
        sized = outlines(texts_of(ids), s).join(several, "id", "left")
        return cut(sized.select("id", "size", F.when(F.col("n") > 1, F.lit(1 << 40)).otherwise(F.col("size")).alias("shared"), "sketch"))

    more = open_pairs(members, roots, tested, s.similarity, sizes_of, lambda ids: bag_sets(texts_of(ids), s))
    if more is not None and not more.isEmpty():
        edges = edges.unionByName(compared(more, rows, s).where("similar").select("a", "b"))
        roots = cut(components(edges))
    placed = classes.join(roots.withColumnRenamed("node", "id"), "id", "left").select("digest", F.coalesce("root", "id").alias("group_id"))
    grouped = signed.select("id", "digest").join(placed, "digest").groupBy("id").agg(F.min("group_id").alias("group_id"))
    alone = docs.where(F.col(key).isNull() | F.col("text").isNull()).select(F.col(key).alias("id")).distinct()
    alone = alone.join(grouped.select("id"), "id", "left_anti").select("id", F.col("id").alias("group_id"))
    whole = cut(grouped.unionByName(alone))
    sizes = whole.groupBy(F.col("group_id").alias("_of")).agg(F.count("*").alias("group_size"))
    return whole.join(sizes, F.col("group_id").eqNullSafe(F.col("_of"))).select(
        F.col("id").alias(key), "group_id", "group_size", F.coalesce(F.col("id") == F.col("group_id"), F.lit(True)).alias("kept"))


def near_duplicate_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's third stage: one document of each group stays."""
    return without(docs, near_duplicates(docs).where("NOT kept").select("doc_id"), "doc_id")


@llm_query("op10_minhash_near_dedup")
def op10_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
