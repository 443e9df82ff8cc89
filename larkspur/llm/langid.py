"""Operator 1, language identification: averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its subwords (letter n-grams inside words,
with the word's edges) hashed into buckets; a linear layer and a softmax give a
probability per language. Embeddings and layer are trained together by stochastic
gradient descent in numpy on a bounded sample; a temperature and a rejection
threshold are fitted on a part of the sample that training did not see.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import llm_query, table


@dataclass(frozen=True)
class Settings:
    """``docs_per_lang`` times ``max_langs`` (the most frequent ones) bounds the sample."""

    sizes: tuple[int, ...] = (2, 3, 4)
    buckets: int = 1 << 15
    dim: int = 16
    docs_per_lang: int = 600
    max_langs: int = 64
    epochs: int = 12
    batch: int = 32
    rate: float = 2.0
    held_for_calibration: float = 0.2
    accept_precision: float = 0.99


SETTINGS = Settings()
UNKNOWN = "und"
PIECE = 1 << 20


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    logits: np.ndarray  # buckets x langs: embedding times layer, as both are linear
    bias: np.ndarray
    temperature: float
    threshold: float
    sizes: tuple[int, ...]


@lru_cache(1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    flags = np.zeros(0x110000, dtype=bool)
    flags[:0x20000] = [chr(c).isalpha() for c in range(0x20000)]
    flags[0x20000:0x323B0] = True  # the ideographs of the second plane
    return flags


def subwords(text: str, sizes: tuple[int, ...], buckets: int, pieces: int = PIECE) -> Iterator[np.ndarray]:
    """Bucket numbers of all subwords of a text, in pieces of bounded size that overlap by what an n-gram needs."""
    longest, text = max(sizes), text.lower()
    for start in range(0, len(text), pieces):
        part = text[max(0, start - 1) : start + pieces + longest].encode("utf-32-le", "replace")
        codes = np.frombuffer(part, dtype=np.uint32)
        codes = np.where(_letters()[np.minimum(codes, 0x10FFFF)], codes, 0)
        codes = np.concatenate([np.zeros(int(start == 0), np.uint32), codes, np.zeros(int(start + pieces >= len(text)), np.uint32)])
        last = pieces if start + pieces < len(text) else len(codes)
        letter = codes != 0
        for n in sizes:
            count = min(len(codes) - n + 1, last)
            if count <= 0:
                continue
            mixed = codes[:count] + np.uint32(n)
            inside = np.ones(count, dtype=bool)
            for k in range(1, n):
                mixed = mixed * np.uint32(0x01000193) ^ (codes[k : k + count] * np.uint32(0x9E3779B1))
                if k < n - 1:
                    inside &= letter[k : k + count]
            inside &= letter[:count] | letter[n - 1 : n - 1 + count]
            mixed = mixed[inside]
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x85EBCA6B)
            yield ((mixed >> np.uint32(13)) % np.uint32(buckets)).astype(np.int32)


def _counted(text: str, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    total = np.zeros(s.buckets, dtype=np.int64)
    for ids in subwords(text, s.sizes, s.buckets):
        total += np.bincount(ids, minlength=s.buckets)
    ids = np.flatnonzero(total)
    return ids.astype(np.int32), (total[ids] / max(1, total.sum())).astype(np.float32)


def sample(docs: DataFrame, s: Settings = SETTINGS) -> pd.DataFrame:
    """At most ``docs_per_lang`` labelled rows (text, lang) of each of the ``max_langs`` most frequent
    languages, the same whatever the layout: chosen by the hash of the text. Columns lang, ids, weights, calib."""
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text", F.xxhash64("text", F.lit("sample")).alias("h"))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(s.max_langs).collect()
    share = F.lit(None).cast("double")
    for r in counts:
        share = F.when(F.col("lang") == r["lang"], min(1.0, 1.5 * s.docs_per_lang / r["count"] + 50 / r["count"])).otherwise(share)
    near = rows.where((F.col("h").cast("double") / 2.0**64 + 0.5) < share)
    order = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [_counted(t, s) for t in batch["text"]]
            yield pd.DataFrame({"lang": batch["lang"], "h": batch["h"], "ids": [p[0] for p in parts], "weights": [p[1] for p in parts]})

    kept = near.withColumn("place", order).where(F.col("place") <= s.docs_per_lang)
    found = kept.mapInPandas(features, "lang string, h long, ids array<int>, weights array<float>").toPandas()
    found = found[found["ids"].map(len) > 0].sort_values(["h", "lang"]).reset_index(drop=True)
    found["calib"] = (found["h"].to_numpy() // 7 % 1000) < 1000 * s.held_for_calibration
    return found


def _mean(ids: list[np.ndarray], weights: list[np.ndarray], matrix: np.ndarray) -> np.ndarray:
    flat, w = np.concatenate(ids), np.concatenate(weights)
    starts = np.cumsum([0] + [len(x) for x in ids[:-1]])
    return np.add.reduceat(matrix[flat] * w[:, None], starts, axis=0)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(found: pd.DataFrame, s: Settings = SETTINGS) -> Model:
    """Stochastic gradient descent on the sample, then temperature and threshold on its calibration part."""
    langs = tuple(sorted(found["lang"].unique()))
    if not langs:
        return Model((), np.zeros((s.buckets, 0), np.float32), np.zeros(0), 1.0, 1.0, s.sizes)
    label = np.searchsorted(np.array(langs), found["lang"].to_numpy(dtype=str))
    ids, weights = list(found["ids"]), list(found["weights"])
    held = found["calib"].to_numpy()
    rows = np.flatnonzero(~held) if (~held).any() else np.arange(len(found))
    rng = np.random.default_rng(7)
    embed = rng.normal(0, 1 / s.dim, (s.buckets, s.dim)).astype(np.float32)
    layer, bias = np.zeros((s.dim, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    for epoch in range(s.epochs):
        rate = s.rate * (1 - epoch / s.epochs)
        order = rng.permutation(rows)
        for at in range(0, len(order), s.batch):
            b = order[at : at + s.batch]
            x = _mean([ids[i] for i in b], [weights[i] for i in b], embed)
            error = _softmax(x @ layer + bias)
            error[np.arange(len(b)), label[b]] -= 1
            error /= len(b)
            back = error @ layer.T
            layer -= rate * (x.T @ error)
            bias -= rate * error.sum(axis=0)
            flat = np.concatenate([ids[i] for i in b])
            step = np.repeat(back, [len(ids[i]) for i in b], axis=0) * np.concatenate([weights[i] for i in b])[:, None]
            place = np.argsort(flat, kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(flat[place]) != 0])
            # The mean spreads a gradient over thousands of buckets: scale it back by the embedding's size.
            embed[flat[place][first]] -= rate * s.dim * np.add.reduceat(step[place], first, axis=0)
    test = np.flatnonzero(held) if held.any() else rows
    z = np.concatenate([_mean([ids[i] for i in part], [weights[i] for i in part], embed) for part in np.array_split(test, -(-len(test) // s.batch))]) @ layer + bias
    truth = label[test]
    loss = lambda t: -np.log(_softmax(z / t)[np.arange(len(test)), truth] + 1e-12).mean()
    temperature = min(np.geomspace(0.1, 10, 41), key=loss)
    p = _softmax(z / temperature)
    score, right = p.max(axis=1), p.argmax(axis=1) == truth
    down = np.argsort(-score)
    precision = np.cumsum(right[down]) / np.arange(1, len(down) + 1)
    good = np.flatnonzero(precision >= s.accept_precision)
    threshold = float(score[down][good[-1]]) if len(good) else 1.0
    return Model(langs, (embed @ layer).astype(np.float32), bias, float(temperature), threshold, s.sizes)


def predict(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and calibrated probability of each text; ``und`` and 0 without letters."""
    buckets, count = model.logits.shape
    names, scores = [], np.zeros(len(texts))
    for i, text in enumerate(texts):
        total, n = np.zeros(count), 0
        for ids in subwords(text or "", model.sizes, buckets, max(1024, PIECE // max(1, count))):
            total += model.logits[ids].sum(axis=0, dtype=np.float64)
            n += len(ids)
        if not n or not count:
            names.append(UNKNOWN)
            continue
        p = _softmax((total / n + model.bias)[None, :] / model.temperature)[0]
        names.append(model.langs[int(p.argmax())])
        scores[i] = p.max()
    return names, np.clip(scores, 0, 1)


def identify(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """Predict the language of every whole text: key, lang_pred, score, accepted.

    ``docs`` needs ``key`` and text; nothing else is read. ``und`` with score 0
    and not accepted: null texts and texts without a letter. ``accepted`` is false
    below the calibrated threshold. Repeated rows each get their row; an empty
    table, or a model learned from no rows, gives only ``und`` or nothing.
    """
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size: buckets x max_langs numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in batches:
            names, scores = predict([t if isinstance(t, str) else None for t in batch["text"]], m)
            yield pd.DataFrame({
                key: batch[key], "lang_pred": names, "score": scores,
                "accepted": [n != UNKNOWN and s >= m.threshold for n, s in zip(names, scores)],
            })

    return docs.select(key, "text").mapInPandas(run, f"`{key}` {kind}, lang_pred string, score double, accepted boolean")


def held_out(key: str):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


@llm_query("op1_language_id")
def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(sample(docs.where("doc_id IS NOT NULL").where(~held_out("doc_id"))))
    return identify(docs, model).withColumn("held_out", held_out("doc_id")).select("doc_id", "held_out", "lang_pred", "score", "accepted")
