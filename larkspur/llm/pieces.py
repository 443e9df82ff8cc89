"""Operator 3, SentencePiece encoding and decoding by batched Viterbi.

The best segmentation of a text under the scores of a SentencePiece model. Texts
are cut where no piece can cross, equal units are solved once, and units of equal
length advance together: at each length the hashes of all substrings probe the
sorted piece hashes, and a vectorised maximum stores the backpointer.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from larkspur.llm.common import llm_query, table

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Fixed values of the file format: field numbers and piece types.
PIECES, PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 1, 2, 3
NORMAL, USER_DEFINED, BYTE = 1, 4, 6
SPACE = "▁"
#: Stands for a literal U+2581 of the text, which must not become a blank. Where a text holds this code point itself, it is the unit "".
LITERAL = "\U0010fffe"
BASE = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN_PENALTY = 10.0
CHARS = 2_000_000
CACHED = 400_000


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if tag & 7 == 2 else 4 if tag & 7 == 5 else 8
            yield tag >> 3, data[at : at + size]
            at += size


@dataclass
class Vocabulary:
    """What a model file holds, as arrays: small, and shipped to the tasks as it is."""

    texts: list[bytes]  # what each id decodes to
    keys: np.ndarray  # sorted hashes of the pieces that can be chosen
    ids: np.ndarray  # their ids
    scores: np.ndarray  # their scores
    longest: int
    byte_ids: np.ndarray  # id of each byte
    unknown: float
    parts: str  # characters that no piece of two or more characters holds

    @classmethod
    def load(cls, path: str = MODEL_PATH) -> Vocabulary:
        with open(path, "rb") as file:
            entries = [dict(_fields(value)) for field, value in _fields(file.read()) if field == PIECES]
        texts, chosen, byte_ids, joined = [], [], np.full(256, -1, np.int32), set()
        for i, e in enumerate(entries):
            text, kind = e[PIECE_TEXT].decode(), e.get(PIECE_TYPE, NORMAL)
            if kind == BYTE:
                byte_ids[int(text[1:-1], 16)] = i
                texts.append(bytes([int(text[1:-1], 16)]))
            elif kind in (NORMAL, USER_DEFINED):
                texts.append(text.replace(SPACE, " ").encode())
                chosen.append((text, i, struct.unpack("<f", e.get(PIECE_SCORE, b"\0\0\0\0"))[0]))
                joined |= set(text) if len(text) > 1 else set()
                if SPACE in text.lstrip(SPACE):
                    raise ValueError(f"piece {text!r} joins two words")
            else:
                texts.append(b"")
        if (byte_ids < 0).any():
            raise ValueError("the model has no piece for some byte")
        hashes = np.array([_hash(text) for text, _, _ in chosen], np.uint64)
        order = np.argsort(hashes)
        keys = hashes[order]
        if (keys[1:] == keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        scores = np.array([s for _, _, s in chosen])
        return cls(
            texts, keys, np.array([i for _, i, _ in chosen], np.int32)[order], scores[order], max(len(t) for t, _, _ in chosen),
            byte_ids, float(scores.min()) - UNKNOWN_PENALTY, "".join(c for c in "\n\t\r" if c not in joined),
        )


def _hash(text: str) -> np.uint64:
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for c in text:
            h = (h ^ np.uint64(ord(c) + 1)) * BASE
            h ^= h >> np.uint64(29)
    return h


def viterbi(units: list[str], v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best piece ids of all units in one array, and where each unit's begin and how many they are.

    Of equal sums the segmentation whose last pieces are longer wins.
    """
    lengths = np.fromiter(map(len, units), np.int64, len(units))
    maybe = np.zeros(1 << 22, dtype=bool)  # which hashes can be keys, by their upper bits
    maybe[v.keys >> np.uint64(42)] = True
    first, sizes, parts, total = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64), [], 0
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        step = max(1, CHARS // (8 * int(n)))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            flat, counts = _equal([units[i] for i in part], int(n), v, maybe)
            sizes[part] = counts
            first[part] = total + np.cumsum(counts) - counts
            parts.append(flat)
            total += len(flat)
    return np.concatenate([np.zeros(0, np.int32), *parts]), first, sizes


def _equal(units: list[str], n: int, v: Vocabulary, maybe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``viterbi`` for units of one length: ids one unit after the other, and their counts."""
    count = len(units)
    codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(count, n).T.astype(np.uint64) + np.uint64(1)
    score, piece = [], []  # by length - 1: of the substring from each start
    h = np.zeros((n, count), np.uint64)
    for size in range(1, min(n, v.longest) + 1):
        h = (h[: n - size + 1] ^ codes[size - 1 :]) * BASE
        h ^= h >> np.uint64(29)
        s = np.full(h.shape, v.unknown if size == 1 else -np.inf)
        p = np.full(h.shape, -1, np.int32)
        at = np.flatnonzero(maybe[(h >> np.uint64(42)).ravel()])
        if len(at):
            wanted = h.ravel()[at]
            place = np.minimum(np.searchsorted(v.keys, wanted), len(v.keys) - 1)
            hit = v.keys[place] == wanted
            s.ravel()[at[hit]] = v.scores[place[hit]]
            p.ravel()[at[hit]] = v.ids[place[hit]]
        score.append(s)
        piece.append(p)
    best = np.full((n + 1, count), -np.inf)
    best[0] = 0
    back = np.zeros((n + 1, count), np.int8 if v.longest < 128 else np.int32)
    for end in range(1, n + 1):
        for size in range(min(end, v.longest), 0, -1):
            value = best[end - size] + score[size - 1][end - size]
            better = value > best[end]
            np.copyto(best[end], value, where=better)
            back[end][better] = size
    end, live, steps = np.full(count, n), np.arange(count), []
    while len(live):
        size = back[end[live], live].astype(np.int64)
        start = end[live] - size
        ids = np.empty(len(live), np.int32)
        for k in np.unique(size):
            of = np.flatnonzero(size == k)
            ids[of] = piece[k - 1][start[of], live[of]]
        steps.append((live, np.where(ids >= 0, ids, -1 - start)))
        end[live] = start
        live = live[start > 0]
    counts = np.zeros(count, np.int64)
    for live, _ in steps:
        counts[live] += 1
    ends = np.cumsum(counts)
    flat = np.empty(int(ends[-1]) if count else 0, np.int32)
    for back_from_end, (live, ids) in enumerate(steps, 1):
        flat[ends[live] - back_from_end] = ids
    return _with_bytes(flat, counts, units, v) if (flat < 0).any() else (flat, counts)


def _with_bytes(flat: np.ndarray, counts: np.ndarray, units: list[str], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Put the bytes of a character that has no piece (marked by its place, negative) in its place."""
    owner = np.repeat(np.arange(len(units)), counts)
    out, grown, at = [], counts.copy(), 0
    for i in np.flatnonzero(flat < 0):
        c = units[owner[i]][-1 - flat[i]]
        data = (SPACE if c == LITERAL else " " if c == SPACE else c).encode()
        out += [flat[at:i], v.byte_ids[list(data)]]
        grown[owner[i]] += len(data) - 1
        at = i + 1
    return np.concatenate([*out, flat[at:]]).astype(np.int32), grown


class Encoder:
    """Encodes and decodes batches of texts; keeps the units it has solved, up to ``CACHED``."""

    def __init__(self, v: Vocabulary):
        self.v = v
        inner = re.escape(v.parts)
        self.unit = re.compile(f"{SPACE}*[^{SPACE}{inner}]+|{SPACE}+" + (f"|[{inner}]" if inner else ""))
        self.sizes = np.array([len(t) for t in v.texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.pool = np.frombuffer(b"".join(v.texts), np.uint8)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.solved = self.v.byte_ids[list(LITERAL.encode())]
        self.first, self.length = np.zeros(1, np.int64), np.full(1, len(self.solved))

    def _units(self, text: str) -> list[str]:
        if LITERAL in text:
            head, *rest = text.split(LITERAL)
            return self._units(head) + [u for part in rest for u in ["", *self.unit.findall(self._marked(part))]]
        return self.unit.findall(self._marked(" " + text if text else ""))

    @staticmethod
    def _marked(text: str) -> str:
        return text.replace(SPACE, LITERAL).replace(" ", SPACE)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):  # by so many characters at a time, whatever the texts' lengths
            stop, chars = at, 0
            while stop < len(texts) and (stop == at or chars + len(texts[stop]) <= CHARS):
                chars += len(texts[stop])
                stop += 1
            out += self._some(texts[at:stop])
            at = stop
        return out

    def _some(self, texts: list[str]) -> list[np.ndarray]:
        found, counts = [], []
        for text in texts:
            units = self._units(text)
            found += units
            counts.append(len(units))
        if len(self.known) > CACHED:
            self._clear()
        if not found:
            return [np.zeros(0, np.int32) for _ in texts]
        codes, unique = pd.factorize(np.array(found, dtype=object))
        get = self.known.get
        where = np.fromiter((get(u, -1) for u in unique), np.int64, len(unique))
        new = np.flatnonzero(where < 0)
        if len(new):
            fresh = [unique[i] for i in new]
            ids, first, sizes = viterbi(fresh, self.v)
            where[new] = len(self.known) + np.arange(len(new))
            self.known.update(zip(fresh, where[new].tolist()))
            self.first = np.concatenate([self.first, len(self.solved) + first])
            self.solved = np.concatenate([self.solved, ids])
            self.length = np.concatenate([self.length, sizes])
        flat, ends = _gather(self.solved, self.first, self.length, where[codes])
        cuts = np.concatenate([[0], ends])[np.cumsum([0] + counts)]
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def decode(self, ids: np.ndarray) -> str:
        data = _gather(self.pool, self.starts, self.sizes, ids)[0].tobytes()
        text = data.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _gather(pool: np.ndarray, first: np.ndarray, length: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices of ``pool`` that ``rows`` name, one after the other, and where each ends."""
    sizes = length[rows]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(first[rows] - (ends - sizes), sizes) + np.arange(total)], ends


def encode(docs: DataFrame, v: Vocabulary, key: str = "doc_id") -> DataFrame:
    """Encode every whole text: key, ids array<int>, n_pieces, decoded_sha256, round_trip.

    ``decoded_sha256`` is of what the ids decode to; ``round_trip`` says whether
    that is the text. A null text has null ids and digest, no pieces and a true
    ``round_trip``; an empty one has no ids. Any text comes back unchanged:
    characters without a piece, and a literal U+2581, go by bytes. Repeated rows
    are encoded alike; extra columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(v)  # one model file

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                texts = [t if isinstance(t, str) else None for t in part["text"]]
                ids = encoder.encode([t or "" for t in texts])
                back = [encoder.decode(x) for x in ids]
                yield pd.DataFrame({
                    key: part[key].to_numpy(),
                    "ids": [None if t is None else x for t, x in zip(texts, ids)],
                    "n_pieces": [len(x) for x in ids],
                    "decoded_sha256": [None if t is None else hashlib.sha256(b.encode()).hexdigest() for t, b in zip(texts, back)],
                    "round_trip": [t is None or t == b for t, b in zip(texts, back)],
                })

    schema = f"`{key}` {kind}, ids array<int>, n_pieces long, decoded_sha256 string, round_trip boolean"
    return docs.select(key, "text").mapInPandas(run, schema)


@llm_query("op3_sentencepiece")
def op3_sentencepiece(spark, sf_dir):
    return encode(table(spark, sf_dir, "documents"), Vocabulary.load())


def pieces_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's last stage: the token ids of every document that is left."""
    return encode(docs, Vocabulary.load()).select("doc_id", "ids", "n_pieces", "decoded_sha256", "round_trip")
