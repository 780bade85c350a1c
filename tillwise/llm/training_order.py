"""Training-order materialisation of token ids as fixed-stride binary shards.

Documents are cut into sequences of ``width`` ids.  Sequence k of n gets the
slot that a keyed Feistel permutation of the numbers below n gives it: the
network permutes the next power of four, and a number that comes out at n or
above goes in again (cycle-walking).  Each slot's record has the same size, so
slot s stands in shard s // per_shard at a fixed place; range partitions of the
slots are sorted and written, one file a shard, and a reader that stopped at a
slot goes on from there by its number alone.  The shards are written in ``WAVES``
runs, each in a folder named by its first shard, so that the shuffle of one run
alone stands beside the token table and the shards.

Numbers follow the written token table: a task numbers its sequences as it
writes them, and the tasks' totals (one number for each task) give the offsets.

A record: slot, sequence number and document id (8 bytes each), number of the
sequence in its document and count of ids (4 bytes each), the ids (2 bytes each,
padded), a line feed.  Little-endian.  Spark's text writer puts the line feed and
commits the files, so a lost executor's shard is written again.

Defined results: a null or empty text is one sequence without ids; a null id is
kept as null; repeated rows are separate documents; an empty table gives no
shards and no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm.byte_bpe import read_ranks, worker_encoder
from tillwise.llm.common import Scratch, blocks, raw_texts, utf8

WIDTH, PER_SHARD, ROUNDS = 512, 1 << 14, 8
#: Runs of shards written one after the other; only one run's shuffle is on disk at a time.
WAVES = 3
#: Spark's setting to delete the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_NULL = -(1 << 63)
#: Characters from which on a text is split by ``byte_bpe``: the library's splitter overflows on runs of a million blanks.
LONG_TEXT = 100_000

_LIBRARIES: dict[tuple, tiktoken.Encoding] = {}


def worker_tokenizer(path: str, pattern: str) -> Callable[[str], np.ndarray]:
    """This process's function from a text to its ids (2 bytes each).

    The order of the sequences does not depend on how their ids are found, so the
    tokenizer library does it; its ids are those of ``byte_bpe``.
    """
    key = (path, pattern)
    if key not in _LIBRARIES:
        _LIBRARIES[key] = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
    short, long = _LIBRARIES[key].encode_ordinary, worker_encoder(path, pattern).encode
    return lambda text: np.array(short(text) if len(text) < LONG_TEXT else long(text), "<u2")


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _round(half: np.ndarray, key: int, number: int, mask: np.uint64) -> np.ndarray:
    x = half + np.uint64((key + number * 0x9E3779B97F4A7C15) & ((1 << 64) - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) & mask


def _network(x: np.ndarray, key: int, bits: int, back: bool) -> np.ndarray:
    mask = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & mask
    for number in range(ROUNDS)[:: -1 if back else 1]:
        if back:
            left, right = right ^ _round(left, key, number, mask), left
        else:
            left, right = right, left ^ _round(right, key, number, mask)
    return (left << np.uint64(bits)) | right


def permuted(numbers: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """Slots of sequence numbers below ``n``; with ``back``, the numbers of slots."""
    out = numbers.astype(np.uint64)
    bits = _half_bits(n)
    walking = np.arange(len(out))
    while len(walking):
        out[walking] = _network(out[walking], key, bits, back)
        walking = walking[out[walking] >= n]
    return out.astype(np.int64)


def record_type(width: int) -> np.dtype:
    return np.dtype([("slot", "<i8"), ("number", "<i8"), ("doc_id", "<i8"), ("part", "<i4"), ("n_ids", "<i4"), ("ids", "<u2", (width,)), ("end", "u1")])


def sequences(df: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(task, place, doc_id, part, ids): the sequences of every text; ``place`` counts them in a task."""
    def cut(batches) -> Iterator[pa.RecordBatch]:
        tokenize, task, place = worker_tokenizer(path, pattern), TaskContext.get().partitionId(), 0
        for batch in batches:
            column, keys = batch.column(1), batch.column(0).to_pylist()
            for i, j in blocks(utf8(column)[1]):
                rows = []
                for key, raw in zip(keys[i:j], raw_texts(column.slice(i, j - i)), strict=True):
                    ids = tokenize(raw.decode())
                    rows += [(key, k, ids[a: a + width].tobytes()) for k, a in enumerate(range(0, max(len(ids), 1), width))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task] * len(rows), pa.int32()), pa.array(range(place, place + len(rows)), pa.int64()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())],
                    names=["task", "place", "doc_id", "part", "ids"])
                place += len(rows)

    return df.select(F.col(doc_id).cast("long"), text).mapInArrow(cut, "task int, place long, doc_id long, part int, ids binary")


def write_shards(scratch: Scratch, cut: DataFrame, path: str, key: int, width: int = WIDTH, per_shard: int = PER_SHARD) -> int:
    """Write the shards of ``sequences`` under ``path``; the number of sequences."""
    spark = cut.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        return _written(scratch, scratch.save(cut), path, key, width, per_shard)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def _written(scratch: Scratch, cut: DataFrame, path: str, key: int, width: int, per_shard: int) -> int:
    """``write_shards`` from the table of the sequences."""
    sizes = dict(cut.groupBy("task").count().collect())  # a number for each task that read the input
    total, offsets = 0, {}
    for task in sorted(sizes):
        offsets[task], total = total, total + sizes[task]
    if not total:
        return 0
    kind = record_type(width)
    shared = cut.sparkSession.sparkContext.broadcast(offsets)

    def filled(first: int, last: int) -> DataFrame:
        """(shard, counted from ``first``; slot; record) of the shards from ``first`` to below ``last``."""
        return cut.mapInArrow(lambda batches: fill(batches, first, last), "shard int, slot long, record binary")

    def fill(batches, first: int, last: int) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(1).to_numpy() + np.array([shared.value[t] for t in batch.column(0).to_pylist()], np.int64)
            slot = permuted(number, total, key)
            mine = np.flatnonzero((slot >= first * per_shard) & (slot < last * per_shard))
            doc_id, part, ids = (batch.column(i).take(pa.array(mine)) for i in range(2, 5))
            out = np.zeros(len(mine), kind)
            out["number"], out["slot"] = number[mine], slot[mine]
            out["doc_id"] = doc_id.fill_null(_NULL).to_numpy()
            out["part"] = part.to_numpy()
            for k, x in enumerate(ids):
                raw = np.frombuffer(x.as_buffer(), "<u2")
                out["n_ids"][k] = len(raw)
                out["ids"][k, : len(raw)] = raw
            records = np.frombuffer(out.tobytes(), np.uint8).reshape(len(out), kind.itemsize)[:, :-1]  # the writer adds the end
            yield pa.RecordBatch.from_arrays([pa.array((out["slot"] // per_shard - first).astype(np.int32)), pa.array(slot[mine]), pa.array([r.tobytes() for r in records], pa.binary())], names=["shard", "slot", "record"])

    shards = -(-total // per_shard)
    run = -(-shards // WAVES)
    for first in range(0, shards, run):
        last = min(first + run, shards)
        ordered = filled(first, last).repartitionById(last - first, F.col("shard")).sortWithinPartitions("slot")
        ordered.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").text(f"{path}/first={first}")
    scratch.drop(cut)
    return total


def read_shards(spark: SparkSession, path: str, width: int = WIDTH, first: int = 0, last: int | None = None, per_shard: int = PER_SHARD) -> DataFrame:
    """Records of the slots from ``first`` to below ``last``, each shard's in order.

    (shard, place, slot, number, doc_id, part, ids); shards outside the range are not opened.
    """
    kind = record_type(width)

    def cut(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0):
                data = np.frombuffer(raw.as_buffer(), kind)
                at = np.arange(len(data))
                keep = (data["slot"] >= first) & (data["slot"] < (last if last is not None else np.iinfo(np.int64).max))
                data, at = data[keep], at[keep]
                ends = np.concatenate(([0], np.cumsum(data["n_ids"]))).astype(np.int32)
                ids = data["ids"][np.arange(width) < data["n_ids"][:, None]].astype(np.int32)
                doc = pa.array(data["doc_id"].copy(), mask=data["doc_id"] == _NULL)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((data["slot"] // per_shard).astype(np.int32)), pa.array(at), pa.array(data["slot"].copy()), pa.array(data["number"].copy()), doc, pa.array(data["part"].copy()), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))],
                    names=["shard", "place", "slot", "number", "doc_id", "part", "ids"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    shard = F.regexp_extract("path", r"first=([0-9]+)", 1).cast("long") + F.regexp_extract("path", r"part-([0-9]+)", 1).cast("long")
    low = F.lit(first // per_shard)
    wanted = files.where(shard >= low) if last is None else files.where((shard >= low) & (shard <= F.lit(max(last - 1, 0) // per_shard)))
    return wanted.select("content").mapInArrow(cut, "shard int, place long, slot long, number long, doc_id long, part int, ids array<int>")


def materialise(df: DataFrame, path: str, pattern: str, key: int, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, per_shard: int = PER_SHARD) -> DataFrame:
    """Write all texts of ``df`` in training order and read the shards again."""
    spark = df.sparkSession
    scratch = Scratch(spark, "training-order")
    folder = scratch.path("shards")
    empty = "shard int, place long, slot long, number long, doc_id long, part int, ids array<int>"
    if not write_shards(scratch, sequences(df, path, pattern, doc_id, text, width), folder, key, width, per_shard):
        return spark.createDataFrame([], empty)
    return read_shards(spark, folder, width, per_shard=per_shard)
