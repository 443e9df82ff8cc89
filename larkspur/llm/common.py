"""What several operators share: the query registry, small expressions, components."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Characters that part words: blank and the control characters tab to carriage return.
GAP = "[\\x20\\x09-\\x0D]"


def llm_query(name: str, sql: str | None = None):
    """Register ``(spark, sf_dir) -> DataFrame`` as a query, with its SQL twin."""

    def register(build):
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Shuffle files of a query go when it has ended, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession):
    """Plans that are made inside remove their shuffle files when they have run; for results that are read once."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the folder that all executors share; the shuffle files behind it are removed."""
    shared_dir(df.sparkSession)
    with tidy(df.sparkSession):
        # A plan takes the setting when it is made.
        return df.select("*").checkpoint(eager=True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also inside nested lambdas."""
    return F.transform(F.array(value), lambda v: body(v)).getItem(0)


def words_of(text: Column) -> Column:
    """The words of a text as an array; null gives none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP + "+"), "")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components: one row (node, root) for every node that has an edge.

    Large-star and small-star steps in turn: each is a grouped minimum, merged
    map-side, joined back to the edges, so no neighbourhood is ever collected and
    adaptive execution may split a hot node. Every round is checkpointed. ``root``
    is the least node of its component. Loops and rows with a null are ignored.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = cut(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.*").where("u <> v").distinct()
        e = cut(small)
        before, state = state, _state(e)
        if state == before:
            break
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def star_pairs(rows: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) from bucket members (bucket, id): each member with the least of its bucket.

    Linear in the members. What such pairs leave open is for ``open_pairs``.
    """
    pivots = rows.groupBy("bucket").agg(F.min("id").alias("b"), F.max("id").alias("last")).where("last > b").select("bucket", "b")
    return rows.join(pivots, "bucket").where("id > b").select(F.col("id").alias("a"), "b").distinct()


def open_members(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """(bucket, least, id, root) of the members that may have a similar partner in their bucket that is not in their component.

    ``roots``: (node, root) of the components found so far. The least member was
    compared with all others, so it needs no pair, and neither does a bucket whose
    other members are all in one component: of two members nothing is left, and
    closed buckets leave the work, which is what becomes of the large groups of copies.
    """
    placed = rows.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    spans = [F.min("root").alias("low"), F.max("root").alias("high")]
    still = placed.groupBy("bucket").agg(F.min("id").alias("least"), F.count("*").alias("n"), *spans).where("low < high AND n > 2")
    rest = cut(placed.join(still.select("bucket", "least"), "bucket").where("id > least"))
    still = rest.groupBy("bucket").agg(*spans).where("low < high").select("bucket")
    return rest.join(still, "bucket", "left_semi").select("bucket", "least", "id", "root")


#: Longs of a parity sketch, and the members from which on a group is not compared pair by pair.
SKETCH, CROWD = 8, 256


def parity_sketch(elements: DataFrame) -> DataFrame:
    """(id, size, sketch) for ``elements`` (id, h), sets of 64-bit hashes: 64 * ``SKETCH`` bits, each flipped by every element that falls on it.

    Two sketches differ in no more bits than the sets differ in elements, so many such bits rule a pair out for certain.
    """
    bit = F.expr("shiftleft(1L, cast(h & 63 AS int))")
    word = F.shiftright("h", 6).bitwiseAND(F.lit(SKETCH - 1))
    words = [F.bit_xor(F.when(word == k, bit).otherwise(F.lit(0).cast("bigint"))) for k in range(SKETCH)]
    return elements.groupBy("id").agg(F.count("*").alias("size"), F.array(*words).alias("sketch"))


def sketches_differ(sketch: Column, sketch2: Column) -> Column:
    """The number of bits in which two sketches differ."""
    return sum((F.bit_count(sketch[k].bitwiseXOR(sketch2[k])) for k in range(SKETCH)), F.lit(0))


def open_pairs(
    rows: DataFrame, roots: DataFrame, tested: DataFrame, similarity: float,
    sizes_of: Callable[[DataFrame], DataFrame], sets_of: Callable[[DataFrame], DataFrame] | None = None, crowd: int = CROWD,
) -> DataFrame | None:
    """Pairs (a, b) that share a bucket, lie in different components, were not tested and can be similar; None if all buckets are closed.

    ``tested``: (a, b, overlap) of all pairs of ``star_pairs``. ``sizes_of`` takes
    ids and gives (id, size, shared): the size of each set, and the most of it that
    any other of these ids has; and, if it can, sketch, of ``SKETCH`` longs that differ
    in no more bits than the sets in elements, as those of ``parity_sketch``.
    ``sets_of`` takes ids and gives (id, set), a row for every set of 64-bit hashes.
    Both may give rows of other ids too.

    Of sets with sizes m and n, a similarity of t takes an overlap of
    t (m + n) / (1 + t). What two members share lies inside the least member of
    their bucket, with which both were compared, or outside it; either part is
    bounded by what each of them has there. So members that have too much of their
    own for every partner leave before pairs are made, pairs that cannot be similar
    are not made, and no pair that is similar is left out. With t = p / q all of
    this is in integers: rounding would lose pairs that are exactly similar.

    Buckets with the same least member are one group. One of more than ``crowd``
    members goes to ``crowd_pairs``.
    """
    t = Fraction(str(similarity))
    p, q = t.numerator, t.denominator
    members = cut(open_members(rows, roots).select("least", "id", "root").distinct())
    if members.isEmpty():
        return None
    sized = sizes_of(cut(members.select("id").distinct()))
    if "sketch" not in sized.columns:
        sized = sized.withColumn("sketch", F.lit(None).cast("array<bigint>"))
    inside = tested.select(F.col("a").alias("id"), F.col("b").alias("least"), "overlap")
    members = members.join(inside, ["id", "least"], "left").join(sized, "id")
    members = cut(members.select("least", "id", "root", "size", "shared", F.coalesce("overlap", "size").alias("inside"), "sketch"))
    small = members.groupBy("least").agg(F.min("size").alias("small"))
    able = members.join(small, "least").where((q * F.col("shared") >= p * F.col("size")) & ((p + q) * F.col("shared") >= p * (F.col("size") + F.col("small"))))
    able = able.drop("small")
    still = able.groupBy("least").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")).where("low < high")
    able = cut(able.join(still.select("least", "n"), "least"))
    few = able if sets_of is None else able.where(F.col("n") <= crowd)
    left = few.drop("n")
    right = left.select("least", *[F.col(c).alias(c + "2") for c in ("id", "root", "size", "shared", "inside", "sketch")])
    outside = F.least(F.col("shared") - F.col("inside"), F.col("shared2") - F.col("inside2"))
    common = F.least("inside", "inside2") + F.greatest(F.lit(0), outside)
    both = F.col("size") + F.col("size2")
    enough = (p + q) * common >= p * both
    near = F.coalesce((p + q) * sketches_differ(F.col("sketch"), F.col("sketch2")) <= (q - p) * both, F.lit(True))
    pairs = left.join(right, (left["least"] == right["least"]) & (F.col("root") < F.col("root2")) & enough & near)
    pairs = pairs.select("id", "id2")
    many = able.where(F.col("n") > crowd).select("least", "id", "root").distinct()
    if sets_of is not None and not many.isEmpty():
        many = cut(many)
        ids = many.select("id").unionByName(many.select(F.col("least").alias("id"))).distinct()
        pairs = pairs.unionByName(crowd_pairs(many, cut(sets_of(cut(ids))), similarity))
    pairs = pairs.select(F.greatest("id", "id2").alias("a"), F.least("id", "id2").alias("b")).where("a <> b").distinct()
    return cut(pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti"))


def crowd_pairs(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (id, id2) from members (least, id, root) of large groups; together with what they link, no similar pair is left out.

    Sets are held as their differences d from one base for each group: the set of
    its least member, less or more what over half of the members have otherwise.
    For any base, A and B differ in as many elements as their differences do, so
    with t = p / q and w = (p + q) |d| - (q - p) |A| they are similar if they share
    at least (w + w') / 2 (p + q) elements of their differences.

    If w + w' is not above 0, both are similar to the member with the least w, and
    are linked by it: one pair for each member. Else they share an element of the
    first |d| - s + 1 ones, in one order for all (rare ones first), where s is what
    any partner takes at least. Near-copies differ from the base in little, and most
    of that is rare, so these rows stay few. An element that is common to i-th and
    j-th place leaves no more than what comes after them.
    """
    t = Fraction(str(similarity))
    p, q = t.numerator, t.denominator
    base = sets.groupBy(F.col("id").alias("least")).agg(F.min("set").alias("base"))
    # A member may have several sets (a key with several texts); each is a row of its own.
    apart = members.join(sets, "id").join(base, "least").select(
        "least", "id", "root", F.size("set").alias("size"), F.xxhash64("set").alias("of"),
        F.concat(F.array_except("set", "base"), F.array_except("base", "set")).alias("d"))
    apart = cut(apart)
    total = apart.groupBy("least").agg(F.count("*").alias("n"))
    held = apart.select("least", F.explode("d").alias("x")).groupBy("least", "x").agg(F.count("*").alias("f"))
    held = cut(held.join(total, "least").where("f > 1"))
    turned = held.where("2 * f > n").groupBy("least").agg(F.collect_list("x").alias("turn"))
    none = F.array().cast("array<bigint>")
    based = apart.join(turned, "least", "left").withColumn("turn", F.coalesce("turn", none))
    based = based.select("least", "id", "root", "of", "size", F.concat(F.array_except("d", "turn"), F.array_except("turn", "d")).alias("d"))
    based = cut(based.withColumn("w", (p + q) * F.size("d") - (q - p) * F.col("size")))
    lows = based.groupBy("least").agg(F.min(F.struct("w", "id", "root")).alias("low"))
    based = based.join(lows, "least")
    linked = F.expr("w + low.w <= 0")
    links = based.where(linked & F.expr("root <> low.root")).select("id", F.col("low.id").alias("id2"))
    # What is linked needs no more pairs among itself.
    based = based.withColumn("root", F.when(linked, F.col("low.root")).otherwise(F.col("root")))
    need = F.greatest(F.lit(1), F.ceil((F.col("w") + F.col("low.w")) / F.lit(2 * (p + q))))
    # Elements of one member only make no pairs, but take their places at the front of the order.
    single = based.select("least", "id", "root", "of", "w", F.size("d").alias("length"), need.alias("need"), F.explode("d").alias("x")).where("need <= length")
    often = held.select("least", "x", F.least("f", F.when(F.expr("2 * f > n"), F.col("n") - F.col("f")).otherwise(F.col("f"))).alias("f"))
    ranked = single.join(often, ["least", "x"], "left").withColumn("f", F.coalesce("f", F.lit(1)))
    order = Window.partitionBy("least", "id", "of").orderBy("f", "x")
    ranked = ranked.withColumn("at", F.row_number().over(order))
    front = cut(ranked.where("at <= length - need + 1 AND f > 1").select("least", "x", "id", "root", "w", (F.col("length") - F.col("at")).alias("after")))
    other = front.select("least", "x", *[F.col(c).alias(c + "2") for c in ("id", "root", "w", "after")])
    open_ = (F.col("w") + F.col("w2") > 0) & (F.col("w") + F.col("w2") <= 2 * (p + q) * (1 + F.least("after", "after2")))
    found = front.join(other, (front["least"] == other["least"]) & (front["x"] == other["x"]) & (F.col("root") < F.col("root2")) & open_)
    return links.unionByName(found.select("id", "id2"))


#: Bits of a bitmap: 2**23 bits are 1 MB, 2**25 bits 4 MB, whatever the number of keys; the wide one is for buckets, of which a line has many.
BITS, WIDE = 23, 25


def bitmap_of(keys: DataFrame, bits: int = BITS) -> Column:
    """A scalar with one bit set for each hash of the only column of ``keys``; null is a key as any other.

    For ``maybe_in``: it keeps rows that cannot find a partner out of a shuffle.
    Its size is fixed, so it may go to every task; the more keys, the less it
    keeps out, and what it lets through is still joined.
    """
    spot = F.pmod(F.xxhash64(keys.columns[0]), F.lit(1 << bits))
    words = keys.select(spot.alias("s")).groupBy(F.shiftright("s", 6).cast("int").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(s & 63 AS int))")).alias("b"))
    dense = keys.sparkSession.range(1 << (bits - 6), numPartitions=1).select(F.col("id").cast("int").alias("w")).join(words, "w", "left")
    return cut(dense.agg(F.sort_array(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0).cast("bigint")).alias("b")))).alias("l")).select(
        F.transform("l", lambda x: x["b"]).alias("bitmap"))).scalar()


def maybe_in(bitmap: Column, key: Column, bits: int = BITS) -> Column:
    """Whether ``key`` may be among the keys of ``bitmap``; never false for one that is."""
    spot = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    return F.bit_get(F.get(bitmap, F.shiftright(spot, 6).cast("int")), F.pmod(spot, F.lit(64)).cast("int")) == 1


def without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is not in ``gone`` (its only column; null is a key as any other).

    Rows that are surely not in it stay where they are; only the rest is joined.
    """
    gone = cut(gone.distinct().withColumnRenamed(gone.columns[0], "_gone"))
    maybe = maybe_in(bitmap_of(gone), F.col(key))
    some = docs.where(maybe).join(gone, F.col(key).eqNullSafe(F.col("_gone")), "left_anti")
    return docs.where(~maybe).unionByName(some)
