"""Operator 13, quality classifier: naive Bayes support vectors.

A text is the set of its n-grams: words and word pairs, and runs of word shapes
(case, digits, symbols, a word said again) by how much of the text they make up.
Every indicator is scaled by its class log-count ratio, which is counted over all
labelled rows; a linear hinge-loss model on the scaled indicators is fitted by
dual coordinate descent on a bounded sample, and its margin is turned into a
probability on a part of the sample that the fit did not see.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import bitmap_of, cut, llm_query, maybe_in, table
from larkspur.session import scratch_path


@dataclass(frozen=True)
class Settings:
    """``rows_per_class`` bounds the sample for the hinge-loss fit; log-count ratios use every labelled row."""

    buckets: int = 1 << 18
    rows_per_class: int = 2000
    smoothing: float = 1.0
    cost: float = 1.0
    epochs: int = 15
    held_for_calibration: float = 0.25
    accept: float = 0.3


SETTINGS = Settings()
PIECE = 1 << 20
LONGEST = 64
#: A run of shapes counts as one indicator for each of these shares of the text that it reaches.
SHARES = (0.0, 1 / 32, 1 / 8, 1 / 2)
SPACE, LOWER, UPPER, DIGIT, SYMBOL = range(5)
#: Shapes of a token: lower, capitalised, upper, digits, symbol; twice, as a word may repeat the word before it.
SHAPES = 10
EMPTY = "no token"


@dataclass(frozen=True)
class Model:
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float


@lru_cache(1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case of every code point."""
    kind, lower = np.full(0x110000, SYMBOL, np.uint8), np.arange(0x110000, dtype=np.uint64)
    for c in range(0x20000):
        ch = chr(c)
        category = unicodedata.category(ch)
        if ch.isspace() or category == "Cc":
            kind[c] = SPACE
        elif category[0] in "LM":
            kind[c] = UPPER if category in ("Lu", "Lt") else LOWER
            small = ch.lower()
            lower[c] = ord(small) if len(small) == 1 else c
        elif category[0] == "N":
            kind[c] = DIGIT
    kind[0x20000:0x323B0] = LOWER  # the ideographs of the second plane
    return kind, lower


@lru_cache(1)
def _powers() -> np.ndarray:
    return np.uint64(0x9E3779B97F4A7C15) ** np.arange(1, LONGEST + 1, dtype=np.uint64)


def _mixed(x: np.ndarray, salt: int, buckets: int) -> np.ndarray:
    """Bucket numbers; ``buckets`` is a power of two."""
    x = (x + np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(65 - buckets.bit_length())).astype(np.int32)


@lru_cache(4)
def _shape_buckets(buckets: int) -> list[list[np.ndarray]]:
    """Bucket of every run of one to three shapes, at every share."""
    return [[_mixed(np.arange(SHAPES**n, dtype=np.uint64), 16 * n + level, buckets) for level in range(len(SHARES))] for n in (1, 2, 3)]


def tokens(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash and shape of the tokens of one piece of text: runs of letters, runs of digits (both cut at LONGEST) and single symbols."""
    kinds, small = _characters()
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    kind = kinds[codes]
    group = kind - (kind == UPPER)
    at = np.arange(len(codes))
    starts = group == SYMBOL
    starts[1:] |= group[1:] != group[:-1]
    starts[0] = True
    place = (at - np.maximum.accumulate(np.where(starts, at, 0))) % LONGEST
    first = np.flatnonzero(place == 0)
    hashes = np.add.reduceat((small[codes] + np.uint64(1)) * _powers()[place], first)
    upper = np.add.reduceat((kind == UPPER).view(np.uint8), first, dtype=np.int64)
    length = np.diff(first, append=len(codes))
    group = group[first]
    shape = (kind[first] == UPPER) + 0 + ((upper == length) & (length > 1))  # 0 lower, 1 capitalised, 2 upper
    shape += 3 * (group == DIGIT) + 4 * (group == SYMBOL)
    keep = np.flatnonzero(group)
    return hashes[keep], shape[keep]


def grams(text: str | None, buckets: int, piece: int = PIECE) -> np.ndarray:
    """Sorted distinct bucket numbers of a text's indicators.

    Long texts are read whole, in pieces cut at white space where there is some;
    the token before a piece goes on into it, so its n-grams are those of the text.
    """
    text = text or ""
    ids: list[np.ndarray] = []
    shapes = [np.zeros(SHAPES**n, np.int64) for n in (1, 2, 3)]
    last_hash, last_shape, last_word = np.empty(0, np.uint64), np.empty(0, np.int64), None
    start, count = 0, 0
    while start < len(text):
        end = min(len(text), start + piece)
        if end < len(text):
            blank = max(text.rfind(c, start, end) for c in " \n\t")
            end = blank + 1 if blank > start else end
        h, s = tokens(text[start:end])
        start = end
        if not len(h):
            continue
        words = np.flatnonzero(s < 3)
        again = np.zeros(len(h), bool)
        if len(words):
            said = h[words]
            again[words[1:]] = said[1:] == said[:-1]
            again[words[0]] = last_word is not None and said[0] == last_word
            last_word = said[-1]
        s = s + 5 * again
        count += len(h)
        ids.append(_mixed(h, 1, buckets))
        chain = np.concatenate([last_hash, h])
        if len(chain) > 1:
            ids.append(_mixed(chain[:-1] * np.uint64(0xD6E8FEB86659FD93) + chain[1:], 2, buckets))
        for n, counts in zip((1, 2, 3), shapes):
            line = np.concatenate([last_shape[max(0, len(last_shape) - n + 1) :], s])
            if len(line) >= n:
                code = line[: len(line) - n + 1]
                for k in range(1, n):
                    code = code + line[k : len(line) - n + 1 + k] * SHAPES**k
                counts += np.bincount(code, minlength=len(counts))
        last_hash, last_shape = h[-1:], np.concatenate([last_shape, s[-2:]])[-2:]
    if not count:
        return _mixed(np.frombuffer(EMPTY.encode(), np.uint64), 7, buckets)
    for counts, tables in zip(shapes, _shape_buckets(buckets)):
        held = np.flatnonzero(counts)
        for share, numbers in zip(SHARES, tables):
            ids.append(numbers[held[counts[held] > share * count]])
    found = np.sort(np.concatenate(ids))
    return found[np.flatnonzero(np.diff(found, prepend=-1))]


def labelled_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """Rows (text, y, h) of documents with a label 0 or 1, once for each text and label: copies do not outweigh other texts.

    A null key has no label; null texts are empty; a text under both labels counts
    for both. Labels go to text hashes first, so that only labelled texts are
    shuffled, copies merged before; the rows are written to the shared folder.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(key).alias("_key"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text", F.lit("quality")))
    marks = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("y")).where("y IN (0, 1)").distinct()
    known = cut(texts.select("_key", "h").join(marks, "_key").select("h", "y").distinct())
    once = texts.where(maybe_in(bitmap_of(known.select("h")), F.col("h"))).groupBy("h").agg(F.min("text").alias("text"))
    path = scratch_path(spark, "labelled")
    once.join(known, "h").select("text", "y", "h").write.parquet(path)
    return spark.read.parquet(path)


def log_count_ratio(rows: DataFrame, s: Settings = SETTINGS) -> np.ndarray:
    """Per bucket the log of the smoothed share of class 1 that holds it over that of class 0; over all ``rows``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((2, s.buckets), np.int64)
        for batch in batches:
            for text, y in zip(batch["text"], batch["y"]):
                held[y, grams(text, s.buckets)] += 1
        at = np.flatnonzero(held.any(axis=0))
        yield pd.DataFrame({"bucket": at.astype(np.int32), "zero": held[0, at], "one": held[1, at]})

    sums = rows.select("text", "y").mapInPandas(count, "bucket int, zero long, one long").groupBy("bucket").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one"))
    found = sums.toPandas()  # at most one row for each of a fixed number of buckets
    held = np.full((2, s.buckets), s.smoothing)
    held[0, found["bucket"]] += found["zero"]
    held[1, found["bucket"]] += found["one"]
    return (np.log(held[1] / held[1].sum()) - np.log(held[0] / held[0].sum())).astype(np.float32)


def sample(rows: DataFrame, s: Settings = SETTINGS) -> pd.DataFrame:
    """At most ``rows_per_class`` rows of each class, chosen by the hash of the text: ids, y, h, weight.

    ``weight`` is how many rows of the class a sampled one stands for.
    """
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    share = F.lit(0.0)
    for y, n in counts.items():
        share = F.when(F.col("y") == y, min(1.0, 1.5 * s.rows_per_class / n + 50 / n)).otherwise(share)
    near = rows.where((F.col("h").cast("double") / 2.0**64 + 0.5) < share)
    kept = near.withColumn("place", F.row_number().over(Window.partitionBy("y").orderBy("h"))).where(F.col("place") <= s.rows_per_class)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"ids": [grams(t, s.buckets) for t in batch["text"]], "y": batch["y"], "h": batch["h"]})

    found = kept.select("text", "y", "h").mapInPandas(features, "ids array<int>, y int, h long").toPandas()
    found = found.sort_values(["h", "y"]).reset_index(drop=True)
    held = found["y"].value_counts()
    found["weight"] = [counts[y] / held[y] for y in found["y"]]
    return found


def scaled(ids: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """The indicators' log-count ratios, to unit length so that long texts do not outvote short ones."""
    x = ratio[ids]
    size = np.float32(np.sqrt((x * x).sum(dtype=np.float64)))
    return x / size if size else x


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: np.ndarray, buckets: int, epochs: int) -> tuple[np.ndarray, np.ndarray]:
    """Linear hinge loss with an L2 penalty: weights (the last one is the bias) and dual variables.

    Minimises |w|²/2 + sum of cost_i max(0, 1 - y_i w·x_i). Each step solves for one
    dual variable exactly, in its box from 0 to cost_i, and moves w along that row.
    Ends early when no projected gradient of an epoch is over 0.001.
    """
    w, alpha = np.zeros(buckets + 1), np.zeros(len(rows))
    norm = np.array([1.0 + (x * x).sum() for _, x in rows])
    rng = np.random.default_rng(11)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            ids, x = rows[i]
            slope = y[i] * (w[ids] @ x + w[-1]) - 1.0
            if alpha[i] <= 0.0:
                slope_in = min(slope, 0.0)
            elif alpha[i] >= cost[i]:
                slope_in = max(slope, 0.0)
            else:
                slope_in = slope
            worst = max(worst, abs(slope_in))
            if slope_in == 0.0:
                continue
            new = min(max(alpha[i] - slope / norm[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            alpha[i] = new
            w[ids] += step * x
            w[-1] += step
        if worst < 1e-3:
            break
    return w, alpha


def _calibrate(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve from margin to probability, by Newton steps with smoothed targets."""
    one, zero = weight[y == 1].sum(), weight[y == 0].sum()
    target = np.where(y == 1, (one + 1) / (one + 2), 1 / (zero + 2))
    a, b = 1.0, float(np.log((one + 1) / (zero + 1)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        g = weight * (p - target)
        k = weight * p * (1 - p) + 1e-12
        hess = np.array([[(k * margin * margin).sum() + 1e-6, (k * margin).sum()], [(k * margin).sum(), k.sum() + 1e-6]])
        move = np.linalg.solve(hess, [(g * margin).sum(), g.sum()])
        a, b = a - float(np.clip(move[0], -2, 2)), b - float(np.clip(move[1], -2, 2))
        if np.abs(move).max() < 1e-9:
            break
    return max(a, 1e-3), b


def train(found: pd.DataFrame, ratio: np.ndarray, s: Settings = SETTINGS) -> Model:
    """Fit on one part of the sample, calibrate on the other. Without both classes every score is 0.5, or the one class's side of it."""
    y = found["y"].to_numpy() if len(found) else np.empty(0, int)
    if len(set(y.tolist())) < 2:
        return Model(ratio, np.zeros(s.buckets, np.float32), 0.0, 1.0, 0.0 if not len(y) else float(2 * y[0] - 1))
    rows = [(ids, scaled(ids, ratio)) for ids in found["ids"]]
    held = (found["h"].to_numpy() // 7 % 1000) < 1000 * s.held_for_calibration
    if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
        held = np.zeros(len(y), bool)
    at = np.flatnonzero(~held)
    share = np.array([(y[at] == k).mean() for k in (0, 1)])
    w, _ = dual_coordinate_descent([rows[i] for i in at], 2.0 * y[at] - 1, s.cost * 0.5 / share[y[at]], s.buckets, s.epochs)
    judge = np.flatnonzero(held) if held.any() else at
    margin = np.array([w[rows[i][0]] @ rows[i][1] + w[-1] for i in judge])
    slope, shift = _calibrate(margin, y[judge], found["weight"].to_numpy()[judge])
    return Model(ratio, w[:-1].astype(np.float32), float(w[-1]), slope, shift)


def probability(texts: list[str | None], m: Model) -> np.ndarray:
    margin = np.empty(len(texts))
    for i, text in enumerate(texts):
        ids = grams(text, len(m.ratio))
        margin[i] = m.weight[ids] @ scaled(ids, m.ratio) + m.bias
    return 1 / (1 + np.exp(-np.clip(m.slope * margin + m.shift, -35, 35)))


def score(docs: DataFrame, model: Model, key: str = "doc_id", accept: float = SETTINGS.accept) -> DataFrame:
    """Score every whole text: key, score (0 to 1), predicted (1 from ``accept`` on).

    ``docs`` needs ``key`` and text; nothing else is read. A null text is an empty
    one, and texts without a token share one indicator of their own. Repeated rows
    and rows with a null key each get their row; no rows give no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size: two numbers a bucket

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = probability([t if isinstance(t, str) else None for t in batch["text"]], shared.value)
            yield pd.DataFrame({key: batch[key], "score": p, "predicted": (p >= accept).astype(np.int32)})

    return docs.select(key, "text").mapInPandas(run, f"`{key}` {kind}, score double, predicted int")


def held_out(key: str):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


@llm_query("op13_quality_classifier")
def op13_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = labelled_rows(docs.where(~held_out("doc_id")), table(spark, sf_dir, "labels"))
    model = train(sample(rows), log_count_ratio(rows))
    return score(docs, model).withColumn("held_out", held_out("doc_id")).select("doc_id", "held_out", "score", "predicted")
