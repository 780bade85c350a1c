"""Prefix trie of conversations: which share how many of their first turns.

A node is a distinct sequence of the first d turns (role, text) of a
conversation; the root has none.  Its members are the conversations that begin
with it, and it carries the smallest member's id.

* A turn is the MD5 of its role and text; no later step moves texts.  Turns are
  numbered, and their digests summed along the conversation, in blocks of
  ``BLOCK`` turns with block offsets, so one endless conversation is many groups.
* A prefix's digest is two sums, over its turns, of 64-bit hashes of (position,
  turn): sums of a conversation's blocks add up, and different prefixes share
  both sums with a chance of about 2 ** -128 a pair.
* A count-min sketch of all prefix digests (counters end at two) is built by the
  tasks and merged.  An estimate of one proves that a prefix has one member: its
  node is made where its row is.  Only other prefixes are shuffled by digest and
  grouped exactly.  The sketch has eight counters a prefix in each of its rows,
  ``CELLS`` at most; beyond that bound more prefixes are shuffled, with the same result.
* Sums over subtrees need no walk through the trie.  A member counts for a
  subtree's saving as far as it is not the smallest member of its own prefixes:
  these are its first turns, so one number a conversation holds for all its
  ancestors.  Leaves likewise: the smallest member of each leaf counts one.
* Lists of the members that end in a node are hashed in pieces of ``PIECE`` ids
  which one task strings together, holding one piece at a time.

Defined results: turns are ordered by (turn, MD5 of role and text), null turns
first; repeated rows are turns of their own; null role or text is empty; rows
without a conversation id belong to no conversation; an empty table gives no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import Scratch, map_batches, mixed

#: Turns of a conversation that are numbered or summed in one group.
BLOCK = 256
#: Ids of a node's list that are strung together in one group.
PIECE = 4096
#: Counters of the sketch in all, two bits each: 16 MB at most.
CELLS = 1 << 26
ROWS = 3
#: Counters of a segment, the unit in which tasks hand over their sketches.
SEGMENT = 1 << 16
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


# --------------------------------------------------------------------------- turns and their prefixes
def numbered(turns: DataFrame) -> DataFrame:
    """(conv, place, turn_md5, size) from (conv_id, turn, role, text); places count from 1."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("turn_md5"), F.length(text).cast("long").alias("size"))
    rows = rows.withColumn("block", F.floor(F.col("turn") / BLOCK))
    inside = Window.partitionBy("conv", "block").orderBy(F.asc_nulls_first("turn"), "turn_md5")
    counts = rows.groupBy("conv", "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy(F.asc_nulls_first("block")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("conv").alias("c"), F.col("block").alias("b"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = rows.withColumn("local", F.row_number().over(inside))
    joined = placed.join(offsets, (F.col("conv") == F.col("c")) & F.col("block").eqNullSafe(F.col("b")))
    return joined.select("conv", (F.col("before") + F.col("local")).alias("place"), "turn_md5", "size")


def by_hundreds(scratch: Scratch, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on a common beginning, and (conv, len) of all of them.

    Conversation c gets the first h turns of conversation c - c % 100 in place of its own first h
    turns, with h = crc32(c in decimal) % 6.
    """
    own = scratch.save(numbered(turns))
    lens = own.groupBy("conv").agg(F.max("place").alias("n"))
    convs = lens.select("conv", "n", (F.col("conv") - F.col("conv") % 100).alias("base"), (F.crc32(F.col("conv").cast("string").cast("binary")) % 6).alias("h"))
    bases = lens.where("conv % 100 = 0").select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(bases, "base", "left").withColumn("given", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = scratch.save(convs.select("conv", "base", "h", "given", (F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")))
    tails = own.join(convs.select("conv", "h", "given"), "conv").where("place > h").select("conv", (F.col("place") - F.col("h") + F.col("given")).alias("place"), "turn_md5", "size")
    heads = own.where("conv % 100 = 0 and place <= 5").withColumnRenamed("conv", "base").join(convs.select("conv", "base", "given"), "base").where("place <= given")
    return tails.unionByName(heads.select("conv", "place", "turn_md5", "size")), convs.select("conv", "len")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, a, b, before_a, before_b, size, chars): digests of the prefix and of the one
    before it, code points of the last turn and of the whole prefix, from (conv, place, turn_md5, size)."""
    def lane(i: int) -> Column:
        return F.xxhash64(F.lit(i), "place", "turn_md5").cast("decimal(20,0)")

    rows = turns.withColumn("block", F.floor((F.col("place") - 1) / BLOCK)).select("conv", "place", "block", "size", lane(1).alias("x"), lane(2).alias("y"))
    sums = rows.groupBy("conv", "block").agg(*(F.sum(c).alias(c) for c in ("x", "y", "size")))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("conv").alias("c"), F.col("block").alias("k"), *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in ("x", "y", "size")))
    running = Window.partitionBy("conv", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.select("conv", "block", "place", "size", "x", "y", *(F.sum(c).over(running).alias(f"{c}1") for c in ("x", "y", "size")))
    whole = inside.join(offsets, (F.col("conv") == F.col("c")) & (F.col("block") == F.col("k")))
    a, b = ((F.col(f"{c}0") + F.col(f"{c}1")).cast("decimal(38,0)") for c in "xy")
    return whole.select("conv", F.col("place").cast("long").alias("depth"), a.alias("a"), b.alias("b"), (a - F.col("x")).cast("decimal(38,0)").alias("before_a"), (b - F.col("y")).cast("decimal(38,0)").alias("before_b"),
                        "size", (F.col("size0") + F.col("size1")).cast("long").alias("chars"))


# --------------------------------------------------------------------------- the sketch
def _cells(low: np.ndarray, high: np.ndarray, width: int) -> list[np.ndarray]:
    """Counter of each prefix (two 64-bit hashes) in each row of the sketch."""
    return [(mixed(low + high * np.uint64(2 * i + 1)) % np.uint64(width)).astype(np.int64) + i * width for i in range(ROWS)]


def _hashes(batch: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (at, at + 1))


def _pack(counts: np.ndarray) -> bytes:
    """Counters of 0, 1 and 2 or more as two bitmaps: at least one, at least two."""
    return np.packbits(counts > 0).tobytes() + np.packbits(counts > 1).tobytes()


def _merged(a: bytes, b: bytes) -> bytes:
    x, y = (np.frombuffer(v, np.uint8).reshape(2, -1) for v in (a, b))
    return np.stack([x[0] | y[0], x[1] | y[1] | (x[0] & y[0])]).tobytes()


def sketch(keys: DataFrame, width: int) -> DataFrame:
    """(segment, bits) of the count-min sketch of ``keys`` (two longs each)."""
    schema = T.StructType([T.StructField("segment", T.IntegerType()), T.StructField("bits", T.BinaryType())])

    def out(rows: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        for segment, bits in sorted(rows.items()):
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([bits], pa.binary())], names=schema.names)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(-(-ROWS * width // SEGMENT) * SEGMENT, np.uint8)
        for batch in batches:
            low, high = _hashes(batch, 0)
            cells, n = np.unique(np.concatenate(_cells(low, high, width)), return_counts=True)
            held[cells] = np.minimum(held[cells] + np.minimum(n, 2), 2)
        yield from out({i: _pack(s) for i, s in enumerate(held.reshape(-1, SEGMENT)) if s.any()})

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, bytes] = {}
        for batch in batches:
            for segment, bits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held[segment] = _merged(held[segment], bits) if segment in held else bits
        yield from out(held)

    # two rounds of merging: a segment of many tasks meets in several places first
    parts = keys.mapInArrow(count, schema).withColumn("salt", F.spark_partition_id() % 32).repartition("segment", "salt").select("segment", "bits").mapInArrow(merge, schema)
    return parts.repartition("segment").mapInArrow(merge, schema)


def screened(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """``rows`` with ``alone`` and ``before_alone``: the estimate of the prefix (of the one before) is one."""
    def keys(i: int, a: str, b: str) -> dict[str, Column]:
        return {f"k{i}": F.xxhash64(F.lit(0), a, b), f"k{i + 1}": F.xxhash64(F.lit(1), b, a)}

    keyed = rows.withColumns(keys(0, "a", "b") | keys(2, "before_a", "before_b"))
    width = min(CELLS // ROWS, max(SEGMENT, 8 * rows.count()))
    # the driver holds one bit for each of CELLS counters at most, whatever the table's size
    flat = np.zeros(-(-ROWS * width // SEGMENT) * SEGMENT // 8, np.uint8)
    for segment, bits in sketch(keyed.select("k0", "k1"), width).collect():
        flat[segment * SEGMENT // 8:(segment + 1) * SEGMENT // 8] = np.frombuffer(bits, np.uint8).reshape(2, -1)[1]
    shared = scratch.spark.sparkContext.broadcast(flat)

    def at_least_two(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        two = shared.value
        return np.logical_and.reduce([(two[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1 for cells in _cells(low, high, width)])

    def judge(batch: pa.RecordBatch) -> list[pa.Array]:
        names = batch.schema.names
        mine, before = (at_least_two(*_hashes(batch, names.index(k))) for k in ("k0", "k2"))
        return [pa.array(~mine), pa.array(~before)]

    fields = [T.StructField("alone", T.BooleanType()), T.StructField("before_alone", T.BooleanType())]
    return map_batches(keyed, judge, fields, keep=rows.columns)


# --------------------------------------------------------------------------- lists of ids
def hashed_lists(scratch: Scratch, members: DataFrame) -> DataFrame:
    """(keys, ends_sha256): SHA-256 of the ascending, comma-joined ids of each key of ``members`` (conv, keys)."""
    keys = [c for c in members.columns if c != "conv"]
    pieces = members.withColumn("piece", F.floor(F.col("conv") / PIECE)).groupBy(*keys, "piece").agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("ids"))
    pieces = scratch.save(pieces)
    n = pieces.groupBy(*keys).agg(F.count("*").alias("pieces"), F.first("ids").alias("ids"))
    short = n.where("pieces = 1").select(*keys, F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))
    schema = T.StructType([members.schema[k] for k in keys] + [T.StructField("ends_sha256", T.StringType())])

    def string(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(key, types, strict=True)] + [pa.array([state.hexdigest()])], names=schema.names)

        for batch in batches:
            types = [batch.schema.field(i) for i in range(len(keys))]
            for *mine, ids in zip(*(batch.column(i).to_pylist() for i in range(len(keys) + 1)), strict=True):
                if mine != key:
                    if key is not None:
                        yield done()
                    key, state = mine, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if key is not None:
            yield done()

    long = pieces.join(n.where("pieces > 1").select(*keys), keys, "left_semi").repartition(*keys).sortWithinPartitions(*keys, "piece")
    return short.unionByName(long.select(*keys, "ids").mapInArrow(string, schema))


# --------------------------------------------------------------------------- the trie
def trie(scratch: Scratch, turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each node, from the turns (conv, place, turn_md5, size) of all conversations ``convs`` (conv, len)."""
    digest = ["depth", "a", "b"]
    rows = scratch.save(prefixes(turns))
    rows = scratch.save(screened(scratch, rows).join(convs, "conv"))
    empty = F.sha2(F.lit("").cast("binary"), 256)
    # prefixes with one member: everything but the parent of the first of them is known here
    alone = rows.where("alone")
    ends = F.when(F.col("depth") == F.col("len"), F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(empty)
    tail = [F.lit(1).cast("long").alias("n_convs"), (F.col("depth") < F.col("len")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), ends.alias("ends_sha256")]
    inner = alone.where("before_alone and depth > 1").select(F.col("conv").alias("conv_id"), "depth", F.col("conv").alias("parent_conv_id"), *tail)
    first = alone.where("not before_alone or depth = 1").select(F.col("conv").alias("conv_id"), "depth", (F.col("depth") - 1).alias("up"), "before_a", "before_b", *tail)

    # prefixes that may have several members
    some = rows.where("not alone")
    nodes = scratch.save(some.groupBy(*digest).agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"), F.max("len").alias("longest"),
                                                   F.first("before_a").alias("before_a"), F.first("before_b").alias("before_b"), F.first("size").alias("size"), F.first("chars").alias("chars")))
    members = scratch.save(some.select("conv", "len", *digest, "chars").join(nodes.select(*digest, "conv_id", "longest"), digest))
    owned = F.col("conv") == F.col("conv_id")
    # code points of a conversation's first turns that a smaller one has as well, and whether it is a leaf's smallest member
    of_conv = members.groupBy("conv").agg(F.max(F.when(~owned, F.col("chars"))).alias("known"), F.max((owned & (F.col("depth") == F.col("len")) & (F.col("longest") == F.col("depth"))).cast("int")).alias("leaf"))
    tails = alone.where("depth = len").select("conv", F.lit(1).alias("tail"))
    of_conv = convs.join(of_conv, "conv", "left").join(tails, "conv", "left")
    of_conv = scratch.save(of_conv.select("conv", "len", F.coalesce("known", F.lit(0)).alias("known"), F.greatest(F.coalesce("leaf", F.lit(0)), F.coalesce("tail", F.lit(0))).alias("leaf")))
    sums = members.join(of_conv.select("conv", "known", "leaf"), "conv").groupBy(*digest).agg(F.sum("leaf").alias("n_leaves"), F.sum(F.when(~owned, F.col("known"))).alias("known"))
    up = [F.col("up").alias("depth"), F.col("before_a").alias("a"), F.col("before_b").alias("b")]
    children = nodes.withColumn("up", F.col("depth") - 1).select(*up).unionByName(first.select(*up)).groupBy(*digest).agg(F.count("*").alias("n_children"))
    lists = hashed_lists(scratch, members.where("depth = len").select("conv", *digest))
    names = scratch.save(nodes.select(*digest, F.col("conv_id").alias("parent_conv_id")))
    full = nodes.join(sums, digest).join(children, digest, "left").join(lists, digest, "left")
    saved = F.coalesce("known", F.lit(0)) - (F.col("n_convs") - 1) * (F.col("chars") - F.col("size"))
    shared = full.select("conv_id", "depth", (F.col("depth") - 1).alias("up"), "before_a", "before_b", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", saved.alias("saved_tokens"), F.coalesce("ends_sha256", empty).alias("ends_sha256"))

    total = scratch.save(of_conv.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"), F.sum("leaf").alias("n_leaves"), F.sum("known").alias("saved_tokens")).where("n_convs > 0"))
    bare = hashed_lists(scratch, convs.where("len = 0").select("conv", F.lit(0).cast("long").alias("depth"))).drop("depth")
    firsts = nodes.where("depth = 1").select("depth").unionByName(first.where("depth = 1").select("depth")).agg(F.count("*"))
    root = total.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", firsts.scalar().alias("n_children"),
                        F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), "saved_tokens", F.coalesce(bare.scalar(), empty).alias("ends_sha256"))
    low = shared.unionByName(first)
    deep = low.where("depth > 1").withColumnsRenamed({"before_a": "a", "before_b": "b"}).withColumnRenamed("depth", "own").withColumnRenamed("up", "depth").join(names, digest, "left")
    # a node before it that is not among the grouped ones has one member, the same as its own
    deep = deep.withColumn("depth", F.col("own")).withColumn("parent_conv_id", F.coalesce("parent_conv_id", "conv_id"))
    top = low.where("depth = 1").withColumn("parent_conv_id", total.select("conv_id").scalar())
    cast = [F.col(c).cast("long").alias(c) if c != "ends_sha256" else F.col(c) for c in NODE]
    return root.select(cast).unionByName(top.select(cast)).unionByName(deep.select(cast)).unionByName(inner.select(cast))


def hundreds_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations that ``by_hundreds`` rebuilds."""
    scratch = Scratch(conversations.sparkSession, "prefix-trie")
    turns, convs = by_hundreds(scratch, conversations)
    return trie(scratch, turns, convs)
