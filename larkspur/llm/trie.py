"""Operator 11, conversation prefix trie: a double array per prefix shard, shared upper nodes merged globally.

Distinct conversations, as sequences of turn digests, are range-partitioned in the
order of their sequences. A run of neighbours is a shard: its trie is packed into
BASE and CHECK arrays over dense turn ids and walked for its nodes. A node off the
paths of a shard's first and last conversation lies in that shard alone and is
final; the nodes on these two paths may be shared and are merged by key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import cut, llm_query, table
from larkspur.llm.streams import ordered_sha256
from larkspur.operators.ranking import number_rows

#: Bytes of a turn's digest.
WIDE = 16
#: Turns of a shard, unless one conversation alone has more.
SHARD_TURNS = 50_000
#: Slots that are looked at together for a free base.
WINDOW = 4096
#: Fixed value: the SHA-256 of no bytes.
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


class DoubleArray:
    """A trie of sequences of ids in BASE and CHECK: the child of ``s`` by ``c`` is ``t = (BASE[s] + c) mod size`` where CHECK[t] is s.

    Slot 0 is the root. ``lines`` are sequences of ids, -1 behind their ends, sorted
    and distinct. Levels are packed from the root down: a node's children keep
    their distances, so a base is tried until all of their slots are free; nodes
    with one child take the free slots in order.
    """

    def __init__(self, lines: np.ndarray):
        count, depth = lines.shape
        nodes = 1 + int((lines >= 0).sum())
        self.size = 1 << int(2 * max(nodes, int(lines.max(initial=0)) + 2)).bit_length()
        self.base = np.zeros(self.size, np.int64)
        self.check = np.full(self.size, -1, np.int64)
        self.check[0] = 0
        self._scan = 0
        at = np.zeros(count, np.int64)
        for d in range(depth):
            rows = np.flatnonzero(lines[:, d] >= 0)
            if not len(rows):
                break
            parent, label = at[rows], lines[rows, d]
            new = np.r_[True, (parent[1:] != parent[:-1]) | (label[1:] != label[:-1])]
            heads = np.flatnonzero(new)
            kin, labels = parent[heads], label[heads]
            starts = np.flatnonzero(np.r_[True, kin[1:] != kin[:-1]])
            sizes = np.diff(np.r_[starts, len(kin)])
            for k in np.flatnonzero(sizes > 1)[np.argsort(-sizes[sizes > 1], kind="stable")]:
                self._place(kin[starts[k]], labels[starts[k] : starts[k] + sizes[k]])
            single = starts[sizes == 1]
            if len(single):
                free = self._free(len(single))
                self.base[kin[single]] = (free - labels[single]) % self.size
                self.check[free] = kin[single]
            at[rows] = (self.base[parent] + label) % self.size

    def _free(self, n: int) -> np.ndarray:
        free = np.flatnonzero(self.check[self._scan :] < 0)
        while len(free) < n:
            self._grow()
            free = np.flatnonzero(self.check[self._scan :] < 0)
        return free[:n] + self._scan

    def _place(self, node: int, labels: np.ndarray) -> None:
        """Find a base for several children: their least one tries free slots, window by window; windows that are nearly full are left behind."""
        low, apart = self._scan, labels - labels[0]
        while True:
            free = np.flatnonzero(self.check[low : low + WINDOW] < 0) + low
            if low == self._scan and len(free) < WINDOW // 10 and low + WINDOW < self.size:
                self._scan += WINDOW
            # The wrap-around would change when the table grows, so only bases that need none are used here.
            for first in free[free >= labels[0]][:: max(1, len(free) // 128)]:
                slots = first + apart
                if slots[-1] < self.size and (self.check[slots] < 0).all():
                    self.base[node] = first - labels[0]
                    self.check[slots] = node
                    return
            low += WINDOW
            if low >= self.size:
                low = self.size
                self._grow()

    def _grow(self) -> None:
        """Double the table; the slots of all children stay as they are."""
        taken = np.flatnonzero(self.check >= 0)
        taken = taken[taken > 0]
        old = self.size
        self.size *= 2
        # A wrapped child's label is slot + old - base; with the doubled size its base moves back by the old size.
        base = self.base[self.check[taken]]
        wrapped = np.unique(self.check[taken[base > taken]])
        self.base = np.r_[self.base, np.zeros(old, np.int64)]
        self.check = np.r_[self.check, np.full(old, -1, np.int64)]
        self.base[wrapped] += old

    def step(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """The children of ``state`` by ``label``; -1 where there is none."""
        to = (self.base[state] + label) % self.size
        return np.where((self.check[to] == state) & (to != 0), to, -1)


def dense(digests: np.ndarray) -> np.ndarray:
    """Ids 0, 1, ... for the distinct digests (rows of bytes), in their order."""
    return np.unique(np.ascontiguousarray(digests).view(f"V{WIDE}").ravel(), return_inverse=True)[1].astype(np.int64).ravel()


_NODE = "kind int, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, size long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_ARROW = pa.schema([
    ("kind", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("size", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string())])
#: A node that is final; final but for its parent's conv_id; shared, with what its own children add.
FINAL, HANGING, SHARED = range(3)
ROOT_KEY = bytes(WIDE)


def shard_nodes(convs: list[int], counts: list[int], shas: list[str], seqs: list[bytes], sizes: list[list[int]]) -> pa.RecordBatch:
    """The nodes of one shard: sorted distinct sequences with their smallest conversation, number of conversations and digest of these."""
    lengths = np.array([len(s) // WIDE for s in seqs])
    rows, depth = len(seqs), int(lengths.max(initial=0))
    lines, sums = np.full((rows, depth), -1, np.int64), np.zeros((rows, depth), np.int64)
    held = np.arange(depth)[None, :] < lengths[:, None]
    flat = np.frombuffer(b"".join(seqs), np.uint8).reshape(-1, WIDE)
    lines[held] = dense(flat) if len(flat) else lines[held]
    sums[held] = np.array([x for s in sizes for x in s], np.int64) if len(flat) else sums[held]
    digests = np.zeros((rows, depth), np.int64)
    digests[held] = np.arange(len(flat))

    trie = DoubleArray(lines)
    conv, count = np.array(convs, np.int64), np.array(counts, np.int64)
    size = trie.size
    n_convs, least = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    level, tokens, turn, ends = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64), np.full(size, -1, np.int64)
    at = np.zeros(rows, np.int64)
    n_convs[0], least[0] = count.sum(), conv.min()
    ends[at[lengths == 0]] = np.flatnonzero(lengths == 0)
    shared = np.zeros(size, bool)
    shared[0] = True
    order = [np.zeros(1, np.int64)]
    for d in range(depth):
        here = np.flatnonzero(held[:, d])
        at[here] = trie.step(at[here], lines[here, d])
        to = at[here]
        np.add.at(n_convs, to, count[here])
        np.minimum.at(least, to, conv[here])
        level[to], tokens[to], turn[to] = d + 1, sums[here, d], digests[here, d]
        last = here[lengths[here] == d + 1]
        ends[at[last]] = last
        shared[to[(here == 0) | (here == rows - 1)]] = True
        order.append(np.unique(to))

    parent = trie.check
    children, leaves, saved = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    for nodes in reversed(order[1:]):
        inner = nodes[~shared[nodes]]
        leaves[inner] += children[inner] == 0
        saved[inner] += (n_convs[inner] - 1) * tokens[inner]
        np.add.at(children, parent[inner], 1)
        np.add.at(leaves, parent[inner], leaves[inner])
        np.add.at(saved, parent[inner], saved[inner])

    keys: dict[int, bytes] = {0: ROOT_KEY}
    for nodes in order[1:]:
        for t in nodes[shared[nodes]].tolist():
            keys[t] = hashlib.md5(keys[int(parent[t])] + flat[turn[t]].tobytes()).digest()
    every = np.concatenate(order)
    up = parent[every]
    kind = np.where(shared[every], SHARED, np.where(shared[up], HANGING, FINAL))
    told = [shas[e] if e >= 0 else None for e in ends[every].tolist()]
    columns = [
        kind, [keys.get(t) for t in every.tolist()], [keys.get(p) if t else None for t, p in zip(every.tolist(), up.tolist())],
        level[every], least[every], np.ma.array(least[up], mask=kind != FINAL), n_convs[every], tokens[every],
        children[every], leaves[every], saved[every], told]
    arrays = [
        pa.array(c.data, f.type, mask=c.mask) if isinstance(c, np.ma.MaskedArray) else pa.array(c, f.type) for c, f in zip(columns, _ARROW)]
    return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)


def _shards(turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "n", "sha256", "seq", "sizes")]
            start, held, longest = 0, 0, 0
            for i, seq in enumerate(columns[3]):
                size = len(seq) // WIDE
                # Sequences lie in a table of rows by depth, so a very long one is not put beside many short ones.
                if i > start and (held + size > turns or (i - start + 1) * max(longest, size) > 8 * turns):
                    yield shard_nodes(*[c[start:i] for c in columns])
                    start, held, longest = i, 0, 0
                held, longest = held + size, max(longest, size)
            if start < len(columns[3]):
                yield shard_nodes(*[c[start:] for c in columns])

    return run


def prefix_trie(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of conversations (conv_id, place, said, size), one row per distinct prefix.

    ``place`` orders a conversation's turns; ``said`` is a turn's digest of 16 bytes,
    ``size`` its tokens. A row with a null place makes its conversation known without
    a turn. Columns: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. No rows give no nodes.

    Equal conversations are one sequence with a count from the start, so a hot one
    costs no more than others. Shards are runs of bounded size of the sorted
    sequences; a hot first turn goes over many of them. What a conversation needs
    in one row is 20 bytes a turn.
    """
    spoken = F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", F.hex("said").alias("said"), "size")))
    lines = turns.groupBy("conv_id").agg(F.sort_array(spoken).alias("l")).select(
        "conv_id", F.unhex(F.array_join(F.transform("l", lambda x: x["said"]), "")).alias("seq"), F.transform("l", lambda x: x["size"]).alias("sizes"))
    lines = cut(lines.withColumn("same", F.unhex(F.sha2("seq", 256))))
    members = ordered_sha256(lines.select("same", "conv_id", F.col("conv_id").cast("string").alias("told")), "same", ["conv_id"], "told", ",")
    members = members.select(F.col("first").alias("first"), "n", "sha256")
    sequences = lines.join(members, F.col("conv_id") == F.col("first")).select("conv_id", "n", "sha256", "seq", "sizes")
    sequences = sequences.repartitionByRange("seq").sortWithinPartitions("seq")
    nodes = cut(sequences.mapInArrow(_shards(shard_turns), _NODE))

    merged = nodes.where(F.col("kind") == SHARED).groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.first("size").alias("size"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"), F.max("ends_sha256").alias("ends_sha256"))
    upper = _upper(cut(merged))
    names = upper.select(F.col("key").alias("k"), F.col("conv_id").alias("above"))
    kept = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    final = nodes.where(F.col("kind") == FINAL).select(*kept)
    below = nodes.where(F.col("kind") == HANGING).join(names, F.col("parent_key") == F.col("k")).withColumn("parent_conv_id", F.col("above")).select(*kept)
    top = upper.drop("above").join(names, F.col("parent_key") == F.col("k"), "left").withColumn("parent_conv_id", F.col("above")).select(*kept)
    return final.unionByName(below).unionByName(top).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)))


def _upper(merged: DataFrame) -> DataFrame:
    """Sums over subtrees for the merged nodes, by pointer doubling: as many rounds as the depth has binary digits.

    After round k a node holds the sums of all nodes less than 2**k below it and the
    key of the node 2**k above it.
    """
    kin = merged.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("k")).agg(F.count("*").alias("more"))
    own = merged.join(kin, F.col("key") == F.col("k"), "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("k", "more")
    own = own.withColumns({
        "n_leaves": F.col("n_leaves") + (F.col("n_children") == 0).cast("long"),
        "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size"), "above": F.col("parent_key")})
    own = cut(own)
    deepest = own.agg(F.max("depth")).first()[0] or 0
    for _ in range(int(deepest).bit_length()):
        adds = own.where("above IS NOT NULL").groupBy(F.col("above").alias("k")).agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        far = own.select(F.col("key").alias("a"), F.col("above").alias("farther"))
        own = own.join(adds, F.col("key") == F.col("k"), "left").join(far, F.col("above") == F.col("a"), "left")
        own = cut(own.withColumns({
            "n_leaves": F.col("n_leaves") + F.coalesce("l", F.lit(0)), "saved_tokens": F.col("saved_tokens") + F.coalesce("s", F.lit(0)),
            "above": F.col("farther")}).drop("k", "l", "s", "a", "farther"))
    return own


def shared_openings(conversations: DataFrame) -> DataFrame:
    """The contract's rebuilt conversations: turns (conv_id, place, said, size), and a row with a null place for every conv_id.

    Turns go by turn, null first; ties by role, then by the MD5 of role and text. Null
    roles and texts are empty. Rows with a null conv_id belong to no conversation and
    are left out; other columns are ignored.
    """
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    said = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    rows = rows.select("conv_id", "turn", "role", said.alias("said"), F.length("text").cast("long").alias("size"))
    rows = cut(number_rows(rows, ["conv_id", "turn", "role", "said"], name="number"))
    starts = cut(rows.groupBy("conv_id").agg(F.min("number").alias("low")))
    starts = starts.withColumns({"opened": F.crc32(F.col("conv_id").cast("string")) % 6, "base": F.col("conv_id") - F.col("conv_id") % 100})
    placed = rows.join(starts.select(F.col("conv_id").alias("c"), "low", "opened"), F.col("conv_id") == F.col("c"))
    placed = placed.withColumn("place", F.col("number") - F.col("low") + 1)
    own = placed.where("place > opened").select("conv_id", "place", "said", "size")
    heads = placed.where("place <= 5 AND conv_id % 100 = 0").select(F.col("conv_id").alias("b"), "place", "said", "size")
    lent = starts.join(heads, F.col("base") == F.col("b")).where("place <= opened").select("conv_id", "place", "said", "size")
    known = starts.select("conv_id", F.lit(None).cast("long").alias("place"), F.lit(None).cast("binary").alias("said"), F.lit(None).cast("long").alias("size"))
    return own.unionByName(lent).unionByName(known)


@llm_query("op11_conversation_prefix_trie")
def op11_conversation_prefix_trie(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie(shared_openings(turns))
