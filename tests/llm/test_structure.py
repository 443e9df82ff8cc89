"""Operator 12."""

import hashlib
import random
import re
import zlib
from itertools import groupby

import pytest

from larkspur import llm
from larkspur.llm import structure

FOLDER = "/root/testdata/sf0.001"
GAPS = " \t\n\x0b\x0c\r"
SHAPE = re.compile(r"(s?(ua)+)?\Z")
COST = {"K": 0, "R": 1, "D": 2, "I": 5}


def _faults(rows):
    """First fault of every (role, text): b, d, t or empty."""
    out, seen = [], set()
    for role, text in rows:
        body = text.strip(GAPS)
        out.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _every_way(rows, faults):
    """(cost, audit, result) of every sequence of edits that costs no more than deleting all turns."""
    most, found = 2 * len(rows), []

    def go(i, cost, audit, result):
        if cost > most:
            return
        if i == len(rows) and SHAPE.match("".join(r[:1] or "?" for r, _ in result)):
            found.append((cost, audit, result))
        for role in ("user", "assistant"):
            go(i, cost + 5, audit + "I", result + [(role, "")])
        if i < len(rows):
            role, text = rows[i]
            go(i + 1, cost + 2, audit + "D", result)
            if faults[i] not in ("b", "d"):
                extra = 5 if faults[i] == "t" else 0
                go(i + 1, cost + extra, audit + "K", result + [(role, text)])
                for new in ("user", "assistant"):
                    go(i + 1, cost + extra + 1, audit + "R", result + [(new, text)])

    go(0, 0, "", [])
    return min(found, key=lambda f: f[:2])


def _table(rows, faults):
    """The same by a table over turns read and role said last; for longer conversations."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def spread(at):
        for _ in range(3):
            for q, (cost, audit, res) in list(at.items()):
                for role in ("user", "assistant"):
                    p = after.get((q, role[0]))
                    way = (cost + 5, audit + "I", res + [(role, "")])
                    if p and (p not in at or way[:2] < at[p][:2]):
                        at[p] = way
        return at

    at = spread({"": (0, "", [])})
    for (role, text), fault in zip(rows, faults):
        new = {}
        for q, (cost, audit, res) in at.items():
            ways = [(q, (cost + 2, audit + "D", res))]
            if fault not in ("b", "d"):
                extra = 5 if fault == "t" else 0
                ways.append((after.get((q, role[:1])), (cost + extra, audit + "K", res + [(role, text)])))
                ways += [(after.get((q, r[0])), (cost + extra + 1, audit + "R", res + [(r, text)])) for r in ("user", "assistant")]
            for p, way in ways:
                if p is not None and (p not in new or way[:2] < new[p][:2]):
                    new[p] = way
        at = spread(new)
    return min((at[q] for q in ("", "a") if q in at), key=lambda f: f[:2])


def _expected(turns, rows, solve):
    faults = _faults(rows)
    cost, audit, result = solve(rows, faults)
    known = [t for t in turns if t is not None]
    initials = [r[:1] for r, _ in rows]
    text = "\n".join(f"{r}:{t}" for r, t in result)
    return (
        max(known) - min(known) + 1 - len(set(known)) if known else 0, faults.count("b"), faults.count("d"), faults.count("t"),
        sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])), cost, audit, hashlib.sha256(text.encode()).hexdigest())


def _random_turns(rng, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool"]
    texts = ["Fine.", "Well!", "cut off", "", " \n", "Fine.", "so? ", "ends. ", "no end"]
    return [(rng.choice(roles) if rng.random() < 0.5 else ("user", "assistant")[k % 2], rng.choice(texts) if rng.random() < 0.4 else f"turn {k}.") for k in range(n)]


def _ask(spark, convs, block):
    data = [(c, t, r, x) for c, rows in convs.items() for t, (r, x) in enumerate(rows)]
    frame = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    return {r.conv_id: tuple(r)[1:] for r in structure.structure_report(frame, frame, block).collect()}


def test_search_against_every_way():
    rng = random.Random(5)
    for _ in range(600):
        rows = _random_turns(rng, rng.randrange(5))
        faults = _faults(rows)
        codes = bytes({"s": 0, "u": 1, "a": 2}.get(r[:1], 3) + 4 * " bdt".index(f or " ") for (r, _), f in zip(rows, faults))
        assert structure.search(codes, (0,), structure.ENDS) == _every_way(rows, faults)[:2] == _table(rows, faults)[:2]


@pytest.mark.parametrize("block", [1, 3, 512])
def test_blocks_make_the_same_repairs(spark, block):
    rng = random.Random(block)
    convs = {c: _random_turns(rng, rng.randrange(1, 40)) for c in range(150)}
    convs[900] = _random_turns(rng, 700)
    got = _ask(spark, convs, block)
    for c, rows in convs.items():
        assert got[c] == _expected(range(len(rows)), rows, _table), c


def test_query_against_brute_force(spark):
    given = sorted(tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect())
    got = {r.conv_id: tuple(r)[1:] for r in llm.QUERIES["op12_conversation_structure_repair"](spark, FOLDER).collect()}
    assert set(got) == {g[0] for g in given}
    for conv, rows in groupby(given, key=lambda g: g[0]):
        turns, left = [], []
        for _, turn, role, text in rows:
            kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            for _ in range({0: 0, 3: 2}.get(kind, 1)):
                turns.append(turn)
                left.append(("user" if kind == 4 else role, text))
        assert got[conv] == _expected(turns, left, _table), conv


def test_odd_conversations(spark):
    empty = hashlib.sha256(b"").hexdigest()
    schema = "conv_id long, turn long, role string, text string, number long, code string, c long, lo long, said string"
    extra = (1, "x", 2, 3, "y")
    rows = [
        (1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, None, None, None), (1, 4, "assistant", "Yes."), (2, None, "user", None),
        (None, 0, "user", "No key."), (None, 1, "assistant", "None."), (3, 0, "", "x."), (4, 0, "user", "w " * 100_000 + "."), (4, 1, "assistant", "Ok. \t"),
    ]
    frame = spark.createDataFrame([r + extra for r in rows], schema)
    damaged = spark.createDataFrame([(5, 0, "user", "gone.")], "conv_id long, turn long, role string, text string").unionByName(frame.select("conv_id", "turn", "role", "text"))
    got = {r.conv_id: tuple(r)[1:] for r in structure.structure_report(frame, damaged).collect()}
    assert got[1][:7] == (3, 1, 1, 0, 2, 4, "DKDK") and got[2][:7] == (0, 1, 0, 0, 0, 2, "D") and got[5] == (0, 0, 0, 0, 0, 0, "", empty)
    assert got[None][:7] == (0, 0, 0, 0, 0, 0, "KK") and got[3][5:7] == (2, "D") and got[4][5:7] == (0, "KK")
    assert got[4][7] == hashlib.sha256(("user:" + "w " * 100_000 + ".\nassistant:Ok. \t").encode()).hexdigest()
    assert structure.structure_report(frame.limit(0), frame.limit(0)).count() == 0
    assert structure.damage(frame).columns == ["conv_id", "turn", "role", "text"]
