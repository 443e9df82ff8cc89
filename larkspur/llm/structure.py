"""Operator 12, conversation structure repair: bidirectional Dijkstra over the edit lattice.

A conversation should be turns of a user and an assistant in alternation, after an
optional system turn. A node of the lattice is how many turns are read and where
the alternation stands; its edges keep, rerole, delete or insert a turn. Searches
from both ends meet; all crossings of the least cost are finished and the least
audit among them is taken. Conversations over a block of turns are searched block
by block, for every way to enter and leave a block, and folded in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from math import inf

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import cut, llm_query, table
from larkspur.llm.streams import ordered_sha256
from larkspur.operators.ranking import number_rows

#: Turns of a conversation that are searched at once.
BLOCK = 512
#: Costs of the edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, STUMP = 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
#: A turn's code is its role (0 system, 1 user, 2 assistant, 3 any other) plus 4 times its fault.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
ROLES = ("system", "user", "assistant")
#: State after a role: 0 nothing yet, 1 system said, 2 user said, 3 assistant said; -1 where the role may not follow.
AFTER = ((1, 2, -1, -1), (-1, 2, -1, -1), (-1, -1, 3, -1), (-1, 2, -1, -1))
#: The role that an inserted or reroled turn gets in each state, and the state then.
WANTED = (1, 1, 2, 1)
THEN = tuple(AFTER[q][WANTED[q]] for q in range(4))
LEGAL = {(0, 1), (1, 2), (2, 1)}
ENDS = (0, 3)


@lru_cache(200_000)
def search(codes: bytes, starts: tuple[int, ...], goals: tuple[int, ...]) -> tuple[int, str] | None:
    """Least cost and, among its paths, the ASCII-least audit from a state in ``starts`` to one in ``goals``; None if there is no way.

    Labels carry their least audit. Within a cost, nodes are settled in the order
    of the turns read, so an edge of cost 0 never reaches a settled node, and no
    audit to a node is the beginning of another one of the same cost: that would
    take inserts, which cost. So the least parts make the least whole.
    """
    n = len(codes)
    ahead: dict[tuple[int, int], tuple[int, str]] = {}
    back: dict[tuple[int, int], tuple[int, str]] = {}
    heap_a = [(0, 0, "", q) for q in sorted(starts)]
    heap_b = [(0, 0, "", q) for q in sorted(goals)]
    best, found = inf, None

    def offer(cost: int, audit: str):
        nonlocal best, found
        if cost < best or (cost == best and audit < found):
            best, found = cost, audit

    def step_ahead():
        cost, i, audit, q = heappop(heap_a)
        if (i, q) in ahead:
            return
        ahead[i, q] = cost, audit
        if (i, q) in back:
            offer(cost + back[i, q][0], audit + back[i, q][1])
        edges = [(i, THEN[q], INSERT, "I")]
        if i < n:
            role, fault = codes[i] % 4, codes[i] // 4
            edges.append((i + 1, q, DELETE, "D"))
            if fault in (FINE, TRUNCATED):
                extra = STUMP if fault == TRUNCATED else 0
                edges.append((i + 1, THEN[q], REROLE + extra, "R"))
                if AFTER[q][role] >= 0:
                    edges.append((i + 1, AFTER[q][role], extra, "K"))
        for j, p, price, edit in edges:
            if (j, p) in back:
                offer(cost + price + back[j, p][0], audit + edit + back[j, p][1])
            if (j, p) not in ahead:
                heappush(heap_a, (cost + price, j, audit + edit, p))

    def step_back():
        cost, left, audit, q = heappop(heap_b)
        i = n - left
        if (i, q) in back:
            return
        back[i, q] = cost, audit
        if (i, q) in ahead:
            offer(cost + ahead[i, q][0], ahead[i, q][1] + audit)
        edges = [(i, p, INSERT, "I") for p in range(4) if THEN[p] == q]
        if i > 0:
            role, fault = codes[i - 1] % 4, codes[i - 1] // 4
            edges.append((i - 1, q, DELETE, "D"))
            if fault in (FINE, TRUNCATED):
                extra = STUMP if fault == TRUNCATED else 0
                edges += [(i - 1, p, REROLE + extra, "R") for p in range(4) if THEN[p] == q]
                edges += [(i - 1, p, extra, "K") for p in range(4) if AFTER[p][role] == q]
        for j, p, price, edit in edges:
            if (j, p) in ahead:
                offer(cost + price + ahead[j, p][0], ahead[j, p][1] + edit + audit)
            if (j, p) not in back:
                heappush(heap_b, (cost + price, n - j, edit + audit, p))

    for _ in goals:
        step_back()
    for _ in starts:
        step_ahead()
    while heap_a and heap_b and heap_a[0][0] + heap_b[0][0] <= best:
        step_ahead() if len(ahead) <= len(back) else step_back()
    return None if found is None else (int(best), found)


def ways(codes: bytes, first: bool, last: bool) -> dict[tuple[int, int], tuple[int, str]]:
    """(state before, state after) -> (cost, audit) of one block. The last block's states after are all those that may end a conversation."""
    out = {}
    for p in (0,) if first else range(4):
        for goals in (ENDS,) if last else ((q,) for q in range(4)):
            way = search(codes, (p,), goals)
            if way:
                out[p, goals[0]] = way
    return out


def edits_of(codes: bytes, state: int, audit: str) -> tuple[list[tuple[int, int, str, str | None]], int]:
    """An audit told in turns: (turns read before it or its own place, inserts since, edit, new role), and the state at its end."""
    out, i, sub = [], 0, 0
    for edit in audit:
        if edit == "I":
            sub += 1
            out.append((i - 1, sub, edit, ROLES[WANTED[state]]))
            state = THEN[state]
            continue
        sub = 0
        if edit == "R":
            out.append((i, 0, edit, ROLES[WANTED[state]]))
            state = THEN[state]
        else:
            out.append((i, 0, edit, None))
            state = AFTER[state][codes[i] % 4] if edit == "K" else state
        i += 1
    return out, state


class _Fold:
    """Blocks of one conversation in order: per state the cheapest way to it, then the edits of the best way."""

    def __init__(self, conv):
        self.conv, self.illegal, self.before = conv, 0, None
        self.best: dict[int, tuple[int, str, tuple]] = {0: (0, "", ())}

    def add(self, lo: int, codes: bytes, first: bool, last: bool) -> None:
        chain = codes if self.before is None else bytes([self.before]) + codes
        self.illegal += sum((a % 4, b % 4) not in LEGAL for a, b in zip(chain, chain[1:]))
        self.before = codes[-1]
        reached: dict[int, tuple[int, str, tuple]] = {}
        for (p, q), (cost, audit) in ways(codes, first, last).items():
            if p in self.best:
                paid, told, chain = self.best[p]
                here = (paid + cost, told + audit)
                if q not in reached or here < reached[q][:2]:
                    reached[q] = (*here, (chain, lo, codes, audit))
        self.best = reached

    def rows(self) -> Iterator[tuple]:
        cost, audit, chain = self.best[0]
        yield self.conv, None, None, None, None, cost, audit, self.illegal
        blocks = []
        while chain:
            chain, *block = chain
            blocks.append(block)
        state, inserted = 0, 0
        for lo, codes, part in reversed(blocks):
            told, state = edits_of(codes, state, part)
            for i, sub, edit, role in told:
                # Inserts at a block's start go on counting after those at the end of the block before.
                sub += inserted if i < 0 else 0
                yield self.conv, lo + i, sub, edit, role, None, None, None
            tail = len(part) - len(part.rstrip("I"))
            inserted = tail + (inserted if tail == len(part) else 0)


_FOUND = "conv_id {0}, number long, sub int, edit string, new_role string, cost long, audit string, illegal long"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fold, out, schema = None, [], None

    def flushed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*out), schema)], schema=schema)

    for batch in batches:
        schema = schema or pa.schema([
            batch.schema.field("conv_id"), ("number", pa.int64()), ("sub", pa.int32()), ("edit", pa.string()), ("new_role", pa.string()),
            ("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64())])
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "lo", "codes", "is_first", "is_last")]
        for conv, lo, codes, first, last in zip(*columns):
            if first:
                fold = _Fold(conv)
            fold.add(lo, bytes(codes), first, last)
            if last:
                for row in fold.rows():
                    out.append(row)
                    if len(out) >= 10_000:
                        yield flushed()
                        out = []
                fold = None
    if out:
        yield flushed()


def repair(turns: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Find faults and the cheapest repair of conversations (conv_id, turn, role, text): a report and the repaired turns.

    The report has a row per conv_id: gaps, blank, duplicate, truncated, illegal,
    cost, audit. The turns have conv_id, number, sub (their order), role, text, edit,
    without those deleted; inserted turns have an empty text.

    Turns go by turn, null first; ties by role, then by the MD5 of role and text, so
    repeated rows stand side by side and count as duplicates. A null role or text is
    one blank; a role that begins with neither s, u nor a (also an empty one) is never
    kept. Rows with a null conv_id are one conversation; other columns are ignored. No
    rows give no rows. A conversation's audit has to fit one row, its texts have not.
    """
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.withColumn("said", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))))
    # The position puts the turns of a conversation side by side; no task holds a whole hot conversation.
    rows = cut(number_rows(rows, ["conv_id", "turn", "role", "said"], name="number"))

    trimmed = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    narrow = rows.select("conv_id", "turn", "number", "said", role.alias("role"), (trimmed == "").alias("blank"),
                         (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("stump"))
    firsts = narrow.groupBy(F.col("conv_id").alias("c"), F.col("said").alias("s")).agg(F.min("number").alias("earliest"), F.count("*").alias("times"))
    seen = firsts.where("times > 1")
    narrow = narrow.join(seen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("said") == F.col("s")), "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("number") > F.col("earliest"), DUPLICATE).when(F.col("stump"), TRUNCATED).otherwise(FINE)
    narrow = cut(narrow.select("conv_id", "turn", "number", (F.col("role") + 4 * fault).cast("tinyint").alias("code")))

    def faults(k: int) -> Column:
        return F.count(F.when(F.shiftright("code", 2) == k, 1))

    spans = narrow.groupBy("conv_id").agg(
        F.min("number").alias("low"), F.max("number").alias("high"), F.min("turn").alias("least"), F.max("turn").alias("most"),
        faults(BLANK).alias("blank"), faults(DUPLICATE).alias("duplicate"), faults(TRUNCATED).alias("truncated"))
    kinds = narrow.where("turn IS NOT NULL").select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.count("*").alias("kinds"))
    spans = cut(spans.join(kinds.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c"))

    placed = narrow.join(spans.select(F.col("conv_id").alias("c"), "low", "high"), F.col("conv_id").eqNullSafe(F.col("c")))
    at = F.floor((F.col("number") - F.col("low")) / block)
    blocks = placed.groupBy("conv_id", "low", "high", at.alias("block")).agg(F.sort_array(F.collect_list(F.struct("number", "code"))).alias("l"))
    blocks = blocks.select(
        "conv_id", F.col("l")[0]["number"].alias("lo"), F.transform("l", lambda x: x["code"]).alias("codes"),
        (F.col("block") == 0).alias("is_first"), (F.col("low") + (F.col("block") + 1) * block > F.col("high")).alias("is_last"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    found = cut(blocks.repartition("conv_id").sortWithinPartitions("conv_id", "lo").mapInArrow(_fold, _FOUND.format(kind)))

    told = found.where("cost IS NOT NULL").select(F.col("conv_id").alias("c"), "cost", "audit", "illegal")
    report = spans.join(told, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", F.coalesce(F.col("most") - F.col("least") + 1 - F.col("kinds"), F.lit(0)).cast("long").alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    kept = found.where("edit IN ('K', 'R')").select(F.col("number").alias("n"), "sub", "edit", "new_role")
    stay = rows.join(kept, F.col("number") == F.col("n")).select("conv_id", "number", "sub", F.coalesce("new_role", "role").alias("role"), "text", "edit")
    new = found.where("edit = 'I'").select("conv_id", "number", "sub", F.col("new_role").alias("role"), F.lit("").alias("text"), "edit")
    return report, stay.unionByName(new)


def damage(turns: DataFrame) -> DataFrame:
    """The contract's faults, put into whole conversations by the checksum of conv_id and turn; nulls count as one blank there."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    rows = turns.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    again = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), again.alias("again")).drop("again")


def structure_report(turns: DataFrame, conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """``repair`` of ``turns`` as the contract's columns, a row for every conv_id of ``conversations``; without turns: zeros and empty strings."""
    report, repaired = repair(turns, block)
    lines = repaired.select("conv_id", "number", "sub", F.concat("role", F.lit(":"), "text").alias("line"))
    digests = ordered_sha256(lines, "conv_id", ["number", "sub"], "line", "\n").select(F.col("conv_id").alias("d"), "sha256")
    every = conversations.select("conv_id").distinct()
    report = report.withColumnRenamed("conv_id", "c")
    out = every.join(report, F.col("conv_id").eqNullSafe(F.col("c")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("d")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(EMPTY_SHA256)
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", nothing).alias("repaired_sha256"))


#: Fixed value: the SHA-256 of no bytes.
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


@llm_query("op12_conversation_structure_repair")
def op12_conversation_structure_repair(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return structure_report(damage(turns), turns)
