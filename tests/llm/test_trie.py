"""Operator 11."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from larkspur import llm
from larkspur.llm import trie

FOLDER = "/root/testdata/sf0.001"


def _rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[conv].append((role or "", text or ""))
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    return out


def _nodes(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    total = {}
    for path in sorted(members, key=len, reverse=True):
        saved = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        total[path] = (sum(total[k][0] for k in kids[path]) or 1, saved + sum(total[k][1] for k in kids[path]))
    out = []
    for path, at in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in at if len(convs[c]) == len(path)))
        above = min(members[path[:-1]]) if path else None
        out.append((min(at), len(path), above, len(at), len(kids[path]), *total[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def _sorted(frame):
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: r[:2])


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _sorted(llm.QUERIES["op11_conversation_prefix_trie"](spark, FOLDER)) == _nodes(_rebuilt(rows))


@pytest.mark.parametrize("shard", [1, 7, 60, 50_000])
def test_shards_make_the_same_nodes(spark, shard):
    rng = random.Random(shard)
    rows = []
    for c in range(400):
        n = rng.choice([1, 2, 3, 5, 9, 30]) if c % 100 else 6
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "ccc", "d" * rng.randrange(3)])) for t in range(n)]
    rows += [(c, t, "user", "same") for c in range(1000, 1200) for t in range(40)]  # copies of one conversation, but for their openings
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert _sorted(trie.prefix_trie(trie.shared_openings(frame), shard)) == _nodes(_rebuilt(rows))


def test_double_array_holds_all_sequences():
    rng = np.random.default_rng(2)
    for width, count, depth in ((3, 200, 9), (40, 800, 4), (2000, 3000, 2), (500, 400, 30)):
        lines = rng.integers(0, width, (count, depth))
        for r, n in enumerate(rng.integers(0, depth + 1, count)):
            lines[r, n:] = -1
        lines = np.unique(lines, axis=0)
        t = trie.DoubleArray(lines)
        state, path = np.zeros(len(lines), int), [() for _ in lines]
        seen = {0: ()}
        for d in range(depth):
            here = np.flatnonzero(lines[:, d] >= 0)
            assert (t.step(state[here], np.full(len(here), width + 5)) == -1).all() or t.size <= 2 * (width + 5)
            state[here] = t.step(state[here], lines[here, d])
            assert (state[here] > 0).all()
            for r in here:
                path[r] += (lines[r, d],)
                assert seen.setdefault(state[r], path[r]) == path[r]
        assert len(set(seen.values())) == len(seen) == len({p[:k] for p in path for k in range(len(p) + 1)})


def test_odd_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, place long, said string, size long, c long, key string"
    extra = (1, "x", 2, 3, "y")
    rows = [
        (0, 0, "user", "hi"), (0, 1, "assistant", None), (0, None, None, "first"), (5, 0, None, None), (7, 0, "user", "w " * 100_000), (7, 1, "a", ""),
        (9, 3, "user", "x"), (None, 0, "user", "nobody"), (100, 0, "user", "hi"), (100, 1, "assistant", ""), (301, 1, "user", "alone"),
    ]
    frame = spark.createDataFrame([r + extra for r in rows], schema)
    got = _sorted(trie.prefix_trie(trie.shared_openings(frame)))
    assert got == _nodes(_rebuilt([r for r in rows if r[0] is not None]))
    assert trie.prefix_trie(trie.shared_openings(frame.limit(0))).count() == 0
    twice = trie.prefix_trie(trie.shared_openings(spark.createDataFrame([(3, 0, "user", "a")] * 3, "conv_id long, turn long, role string, text string")))
    assert max(r[1] for r in _sorted(twice)) == max(0, 3 - zlib.crc32(b"3") % 6)
