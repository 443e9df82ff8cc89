"""Operator 8, benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The n-grams of test items that are rarest in the corpus are looked up in every
document, so many of an item that each copy which scores enough holds one. Where
one occurs, the item is aligned with that part of the document; the local
alignment's score, as a share of the item's length, tells an exact, edited or
paraphrased copy from a chance meeting.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.bagminhash import GOLDEN, _portions, mix
from larkspur.llm.common import llm_query, table, without


@dataclass(frozen=True)
class Settings:
    """A word that agrees scores 1; a word put in, left out or exchanged costs 1.

    An item is leaked if its best alignment scores ``min_share`` of its length and
    ``min_words`` at least (its whole length, if it is shorter). ``block_chars`` of
    benchmark text are held by a task at once; more go in several passes.

    ``n`` is 2, as a copy can reach half the length with no three words in a row
    (a word put in after every second one).
    """

    n: int = 2
    min_share: float = 0.5
    min_words: int = 8
    block_chars: int = 8_000_000


SETTINGS = Settings()


def enough(length: np.ndarray, s: Settings) -> np.ndarray:
    """The least alignment score at which an item of so many words is leaked."""
    return np.maximum(np.ceil(s.min_share * length), np.minimum(s.min_words, length)).astype(np.int64)


EDGES = "*#$%&|<>.,;:!?'\"()[]{}-_=+~^`/\\‘’“”–—…¡¿«»"


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts, lower-cased and without marks at their edges, and how many each text has."""
    words, counts = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = text.lower().split()
        counts[i] = len(own)
        words += own
    if not words:
        return np.zeros(0, np.uint64), counts
    codes, unique = pd.factorize(np.array(words, dtype=object))
    bare = np.array([w.strip(EDGES) for w in unique], dtype=object)
    hashed = pd.util.hash_array(bare, categorize=False)
    keep = np.array([w != "" for w in bare], dtype=bool)[codes]
    if keep.all():
        return hashed[codes], counts
    owner = np.repeat(np.arange(len(texts)), counts)[keep]
    return hashed[codes[keep]], np.bincount(owner, minlength=len(texts))


def grams(hashes: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams that lie inside one text, and where each begins."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = len(hashes) - n + 1
    h = np.full(size, n, np.uint64)
    for k in range(n):
        h = mix(h + hashes[k : k + size] * GOLDEN)
    ends = np.repeat(np.cumsum(counts), counts)[:size]
    at = np.flatnonzero(np.arange(size) + n <= ends)
    return h[at], at


@dataclass
class Block:
    """A bounded part of the benchmark as arrays: the items' words, and the seeds that point into them."""

    ids: list
    words: np.ndarray
    first: np.ndarray
    length: np.ndarray
    sizes: tuple[int, ...]  # n-gram sizes in use: n, and the length of every shorter item
    keys: np.ndarray  # sorted distinct seeds
    starts: np.ndarray  # for each key, its first row in item and offset; one more at the end
    item: np.ndarray
    offset: np.ndarray

    @classmethod
    def build(cls, ids: list, texts: list[str], s: Settings) -> Block:
        words, length = word_hashes(texts)
        first = np.cumsum(length) - length
        sizes = tuple(sorted({min(s.n, int(n)) for n in length if n}))
        key, item, offset = [], [], []
        for n in sizes:
            own = (length >= n) if n == s.n else (length == n)
            h, at = grams(words, length, n)
            of = np.repeat(np.arange(len(ids)), length)[at]
            use = own[of]
            key.append(h[use])
            item.append(of[use])
            offset.append(at[use] - first[of[use]])
        empty = np.zeros(0, np.int64)
        key, item, offset = (np.concatenate([e, *x]) for e, x in ((np.zeros(0, np.uint64), key), (empty, item), (empty, offset)))
        order = np.argsort(key, kind="stable")
        keys, starts = np.unique(key[order], return_index=True)
        return cls(ids, words, first, length, sizes, keys, np.append(starts, len(key)), item[order], offset[order])

    def rarest(self, counts: np.ndarray, s: Settings) -> Block:
        """Keep, for every item, the n-grams that fewest documents hold (``counts`` by key), as many as no copy can do without.

        An alignment in r runs of equal words has r - 1 edits at least, so with a score
        of S it holds S - 1 of the item's pairs of words. Whichever they are, one is
        among any (length - S + 1) of its pairs. Pairs that no document holds count.
        """
        of_key = np.repeat(np.arange(len(self.keys)), np.diff(self.starts))
        order = np.lexsort((self.offset, counts[of_key], self.item))
        total = np.bincount(self.item, minlength=len(self.ids))
        place = np.arange(len(order)) - (np.cumsum(total) - total)[self.item[order]]
        wanted = self.length - enough(self.length, s) + 1 if s.n <= 2 else total
        keep = np.sort(order[(place < wanted[self.item[order]]) & (counts[of_key][order] > 0)])
        keys, starts = np.unique(self.keys[of_key[keep]], return_index=True)
        return Block(self.ids, self.words, self.first, self.length, self.sizes, keys, np.append(starts, len(keep)), self.item[keep], self.offset[keep])

    def find(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` where a seed begins, and the seed's number."""
        places, seeds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(self.keys):
            maybe = np.zeros(1 << 20, dtype=bool)
            maybe[self.keys >> np.uint64(44)] = True
            for n in self.sizes:
                h, at = grams(hashes, counts, n)
                near = np.flatnonzero(maybe[h >> np.uint64(44)])
                row = np.minimum(np.searchsorted(self.keys, h[near]), len(self.keys) - 1)
                hit = self.keys[row] == h[near]
                places.append(at[near[hit]])
                seeds.append(row[hit])
        return np.concatenate(places), np.concatenate(seeds)

    def candidates(self, hashes: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        """Parts of documents to align: doc, item, low, high (in ``hashes``); parts that overlap are one."""
        place, seed = self.find(hashes, counts)
        times = self.starts[seed + 1] - self.starts[seed]
        row = np.repeat(self.starts[seed], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        place = np.repeat(place, times)
        ends = np.cumsum(counts)
        doc = np.searchsorted(ends, place, side="right")
        item = self.item[row]
        slack = self.length[item] // 2 + 2
        low = np.maximum(place - self.offset[row] - slack, (ends - counts)[doc])
        high = np.minimum(place - self.offset[row] + self.length[item] + slack, ends[doc])
        order = np.lexsort((low, item, doc))
        doc, item, low, high = doc[order], item[order], low[order], high[order]
        if not len(doc):
            return pd.DataFrame({"doc": doc, "item": item, "low": low, "high": high})
        same = (doc[1:] == doc[:-1]) & (item[1:] == item[:-1])
        # Within a document and item all parts have one length, so the last high is the largest so far.
        new = np.r_[True, ~(same & (low[1:] <= high[:-1]))]
        at = np.flatnonzero(new)
        last = np.r_[at[1:], len(doc)] - 1
        return pd.DataFrame({"doc": doc[at], "item": item[at], "low": low[at], "high": np.maximum(high[last], high[at])})

    def align(self, hashes: np.ndarray, parts: pd.DataFrame, cells: int = 2_000_000) -> np.ndarray:
        """The best local alignment score of each part with its item."""
        scores = np.zeros(len(parts), np.int64)
        width = (parts["high"] - parts["low"]).to_numpy()
        item, low = parts["item"].to_numpy(), parts["low"].to_numpy()
        order = np.lexsort((width, self.length[item]))
        at = 0
        while at < len(order):
            stop = at + 1
            while stop < len(order) and (stop + 1 - at) * max(width[order[at : stop + 1]].max(), 1) <= cells and stop - at < 4096:
                stop += 1
            rows = order[at:stop]
            scores[rows] = smith_waterman(
                [self.words[self.first[i] : self.first[i] + self.length[i]] for i in item[rows]],
                [hashes[a : a + w] for a, w in zip(low[rows], width[rows])])
            at = stop
        return scores


def smith_waterman(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Best local alignment scores of many pairs of word sequences at once: one row of all matrices at a time."""
    rows, cols = max(map(len, left)), max(map(len, right))
    a = np.zeros((rows, len(left)), np.uint64)
    has = np.zeros((rows, len(left)), dtype=bool)
    b = np.zeros((len(left), cols), np.uint64)
    real = np.zeros((len(left), cols), dtype=bool)
    for i, (x, y) in enumerate(zip(left, right)):
        a[: len(x), i], has[: len(x), i] = x, True
        b[i, : len(y)], real[i, : len(y)] = y, True
    ramp = np.arange(cols + 1)
    before = np.zeros((len(left), cols + 1), np.int64)
    best = np.zeros(len(left), np.int64)
    for k in range(rows):
        now = np.zeros_like(before)
        now[:, 1:] = np.maximum(before[:, :-1] + np.where((b == a[k][:, None]) & real, 1, -1), before[:, 1:] - 1)
        now = np.maximum(np.maximum.accumulate(now + ramp, axis=1) - ramp, 0)
        now[~has[k]] = 0
        before = now
        best = np.maximum(best, now.max(axis=1))
    return best


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item_key: str = "item_id", s: Settings = SETTINGS) -> DataFrame:
    """Copies of test items in documents: key, item_id, score (alignment score by item length).

    ``docs`` needs ``key`` and text, ``benchmark`` ``item_key`` and text; other
    columns are not read. One row for each document and leaked item. Null and
    empty texts, and items without a word, match nothing; rows that share a key
    are one document with the best score of either. Equal items are each found.

    The corpus is read twice for each block of the benchmark, once to count in how
    many documents each n-gram occurs and once to look for the seeds; nothing but
    counts and finds leaves the tasks. A block is bounded by ``block_chars`` (one
    longer item is a block), which is measured before anything is shipped.
    """
    kind, item_kind = docs.schema[key].dataType.simpleString(), benchmark.schema[item_key].dataType.simpleString()
    texts = docs.where(F.col("text").isNotNull()).select(key, "text")
    items = benchmark.where(F.col("text").isNotNull() & F.col(item_key).isNotNull()).select(item_key, "text")
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-2 * chars // s.block_chars))
    found = None
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("text", item_key), F.lit(blocks)) == k).orderBy(item_key, "text").collect()
        part = _leaks_of_block(texts, Block.build([r[0] for r in own], [r[1] for r in own], s), key, kind, item_key, item_kind, s)
        found = part if found is None else found.unionByName(part)
    return found.groupBy(key, item_key).agg(F.max("score").alias("score"))


def _leaks_of_block(texts: DataFrame, block: Block, key: str, kind: str, item_key: str, item_kind: str, s: Settings) -> DataFrame:
    sc = texts.sparkSession.sparkContext
    everything = sc.broadcast(block)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        b = everything.value
        total = np.zeros(len(b.keys), np.int64)
        for batch in batches:
            whole = batch["text"].tolist()
            for part in _portions(whole):
                hashes, counts = word_hashes(whole[part])
                place, seed = b.find(hashes, counts)
                doc = np.searchsorted(np.cumsum(counts), place, side="right")
                total += np.bincount(np.unique(seed * len(counts) + doc) // len(counts), minlength=len(total))
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"seed": seen, "n": total[seen]})

    sums = texts.select("text").mapInPandas(count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(block.keys), np.int64)
    counts[sums["seed"].to_numpy(dtype=np.int64)] = sums["n"]
    seeded = sc.broadcast(block.rarest(counts, s))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        b = seeded.value
        least = enough(b.length, s)
        for batch in batches:
            whole, keys = batch["text"].tolist(), batch[key].to_numpy()
            for part in _portions(whole):
                hashes, counts = word_hashes(whole[part])
                parts = b.candidates(hashes, counts)
                item = parts["item"].to_numpy()
                scores = b.align(hashes, parts)
                good = scores >= least[item]
                yield pd.DataFrame({
                    key: keys[part][parts["doc"].to_numpy()[good]], item_key: [b.ids[i] for i in item[good]],
                    "score": scores[good] / b.length[item[good]]})

    return texts.mapInPandas(search, f"`{key}` {kind}, `{item_key}` {item_kind}, score double")


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item_key: str = "item_id", s: Settings = SETTINGS) -> DataFrame:
    """Judge every row of ``docs``: key, contaminated, items (sorted item ids), score (best, 0 if none).

    See ``leaks``. Rows with a null key are never contaminated; repeated rows each
    give a row; without items or documents nothing is contaminated.
    """
    by_doc = leaks(docs, benchmark, key, item_key, s).groupBy(F.col(key).alias("_key")).agg(
        F.sort_array(F.collect_set(item_key)).alias("items"), F.max("score").alias("score"))
    ids = docs.select(key)
    none = F.array().cast(by_doc.schema["items"].dataType)
    return ids.join(by_doc, ids[key] == by_doc["_key"], "left").select(
        key, F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", none).alias("items"), F.coalesce("score", F.lit(0.0)).alias("score"))


def decontamination_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's fourth stage: documents that hold a test item go."""
    return without(docs, leaks(docs, table(spark, sf_dir, "benchmark")).where("doc_id IS NOT NULL").select("doc_id"), "doc_id")


@llm_query("op8_benchmark_decontamination")
def op8_benchmark_decontamination(spark, sf_dir):
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
