"""Benchmark decontamination as a prefix-filtered set join.

An item's window is ``size`` consecutive words (an item of fewer words is one
window).  A window is a set of shingles of ``SHINGLE`` words; it occurs in a
document only if all of them do, so for containment 1 the necessary prefix of
its shingles, ordered by rarity over all documents, is the rarest one alone.

1. Benchmark: windows and their shingle hashes.
2. First pass over the documents: how often each benchmark shingle occurs.
3. Second pass: places of documents where a prefix shingle stands, each with
   the words around it that a window could cover.
4. Join on the prefix shingle; length and positional bounds; the words of the
   window are compared exactly, so hash collisions change nothing.

Both passes test shingles in a bitmap of fixed size (``bitmap_bits``) first; a
hash that slips through is dropped by the joins.  That bitmap is all that is
broadcast, whatever the size of the benchmark.

Defined results: a null or empty text has no words, no hits and no items; an
item without words is ignored; equal items all count, a repeated item_id once;
a null item_id never enters the list but its windows count as hits; repeated
documents get one row each; an empty benchmark marks nothing; other columns are
left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import Scratch, blocks, fresh, mixed, powers, utf8

SHINGLE = 3
BITMAP_BITS = 1 << 24
#: Counts that a task holds before it passes them on.
HELD = 1 << 18

_STEP = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))


def _lower_words() -> np.ndarray:
    """Byte table: A-Z to a-z, 0 for what separates words."""
    out = np.arange(256, dtype=np.uint8)
    byte = np.arange(256)
    upper = (byte >= 0x41) & (byte <= 0x5A)
    word = ((byte >= 0x30) & (byte <= 0x39)) | upper | ((byte >= 0x61) & (byte <= 0x7A)) | (byte >= 0x80)
    out[upper] += 32
    out[~word] = 0
    return out


LOWER_WORDS = _lower_words()


class Words:
    """Words and shingle hashes of consecutive texts that lie in one buffer."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.bytes = LOWER_WORDS[data[offsets[0]: offsets[-1]]]
        cuts = offsets - offsets[0]
        n = len(self.bytes)
        word = self.bytes != 0
        edge = np.zeros(n + 1, bool)
        edge[cuts] = True  # a text's border ends a word
        before = np.concatenate(([False], word))
        after = np.concatenate((word, [False]))
        self.start = np.flatnonzero(after & (~before | edge))
        self.end = np.flatnonzero(before & (~after | edge))
        self.first = np.searchsorted(self.start, cuts)  # each text's first word
        up, down = powers(n + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.bytes * up[:n], dtype=np.uint64)))
        self.hash = mixed((sums[self.end] - sums[self.start]) * down[self.start])
        self.text_of = np.repeat(np.arange(len(cuts) - 1), np.diff(self.first))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of all runs of ``k`` words inside a text."""
        if len(self.hash) < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        m = len(self.hash) - k + 1
        h = np.full(m, k, np.uint64)
        for i in range(k):
            h = (h ^ self.hash[i: i + m]) * _STEP[i % len(_STEP)]
            h ^= h >> np.uint64(31)
        at = np.flatnonzero(self.text_of[:m] == self.text_of[k - 1:])
        return at, h[at]

    def joined(self, a: int, b: int) -> str:
        """Words a to b, one space between."""
        return b" ".join(self.bytes[self.start[i]: self.end[i]].tobytes() for i in range(a, b)).decode("utf-8", "replace")


def windows_of(benchmark: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """(item_id, window, n_words, shingles: array of hashes) of every item."""
    def cut(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = utf8(batch.column(1))
            for i in range(len(ids)):
                w = Words(data, offsets[i: i + 2])
                n = len(w.start)
                width = min(size, n)
                k = min(SHINGLE, width)
                if not n:
                    continue
                hashes = w.shingles(k)[1].view(np.int64)
                at = range(n - width + 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[i]] * len(at), pa.string()),
                    pa.array([w.joined(j, j + width) for j in at]),
                    pa.array([width] * len(at), pa.int32()),
                    pa.array([hashes[j: j + width - k + 1] for j in at], pa.list_(pa.int64())),
                ], names=["item_id", "window", "n_words", "shingles"])

    return benchmark.select(F.col(item_id).cast("string"), F.col(text)).mapInArrow(cut, "item_id string, window string, n_words int, shingles array<long>")


def bitmap_of(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bits of the ``hash`` column's low bits: ``bits / 8`` bytes however many rows there are."""
    slot = F.col("hash").bitwiseAND(F.lit(bits - 1))
    words = hashes.select(F.shiftright(slot, 6).alias("word"), F.expr(f"shiftleft(1L, cast(hash & 63 as int))").alias("bit"))
    out = np.zeros(bits // 64, np.int64)
    got = words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toPandas()
    out[got["word"].to_numpy(np.int64)] = got["bit"].to_numpy(np.int64)
    return out.view(np.uint64)


def _passing(h: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    slot = h & np.uint64(len(bitmap) * 64 - 1)
    return np.flatnonzero((bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1))


def shingle_counts(docs: DataFrame, text: str, bitmap, widths: list[int]) -> DataFrame:
    """(hash, n): occurrences in all documents of the shingles that pass the bitmap."""
    def count(batches):
        held: dict[int, int] = {}

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.int64())], names=["hash", "n"])

        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for i, j in blocks(offsets):
                w = Words(data, offsets[i: j + 1])
                for k in widths:
                    _, h = w.shingles(k)
                    found, n = np.unique(h[_passing(h, bitmap.value)].view(np.int64), return_counts=True)
                    for x, m in zip(found.tolist(), n.tolist(), strict=True):
                        held[x] = held.get(x, 0) + m
                if len(held) > HELD:
                    yield out()
                    held.clear()
        yield out()

    return docs.select(text).mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


PLACES = "array<struct<hash: bigint, at: int, lead: int, words: string>>"


def places(docs: DataFrame, text: str, bitmap, widths: list[int], size: int, keep: list[str], names: tuple[str, str]) -> DataFrame:
    """``keep`` plus the number of words and the places where a prefix shingle may stand.

    A place: the shingle's hash, its first word's number, and the words around it
    (``lead`` of them before it) that a window with this shingle could cover.
    """
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int32()), ("lead", pa.int32()), ("words", pa.string())]))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema), f"`{names[0]}` bigint", f"`{names[1]}` {PLACES}"])

    def find(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
            for i, j in blocks(offsets):
                w = Words(data, offsets[i: j + 1])
                rows: list[list] = [[] for _ in range(j - i)]
                for k in widths:
                    at, h = w.shingles(k)
                    for x in _passing(h, bitmap.value).tolist():
                        a = int(at[x])
                        t = int(w.text_of[a])
                        low, high = max(int(w.first[t]), a - size + k), min(int(w.first[t + 1]), a + size)
                        rows[t].append({"hash": int(h[x].view(np.int64)), "at": a - int(w.first[t]), "lead": a - low, "words": w.joined(low, high)})
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in keep), pa.array(w.counts(), pa.int64()), pa.array(rows, kind)], names=[*keep, *names])

    return docs.mapInArrow(find, schema)


class Decontaminator:
    """Marks every row of ``docs`` against ``benchmark``.

    ``marked``: the kept columns, ``row`` (an id of the row), ``n_words``;
    ``hits``: (row, start, n_words, window), one row for each occurrence.
    """

    def __init__(self, docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", keep: list[str] | None = None, size: int = 10, bitmap_bits: int = BITMAP_BITS):
        spark = docs.sparkSession
        keep = docs.columns if keep is None else keep
        self.scratch = scratch = Scratch(spark, "decontaminate")
        self.row, self.n_words, found = (fresh(docs, x) for x in ("row", "n_words", "found"))
        self.items = scratch.save(windows_of(benchmark, item_id, item_text, size))
        self.windows = scratch.save(self.items.groupBy("window").agg(F.min("n_words").alias("n_words"), F.min("shingles").alias("shingles")))
        widths = [r[0] for r in self.windows.select(F.least("n_words", F.lit(SHINGLE))).distinct().collect()]  # at most SHINGLE values
        each = self.windows.select("window", "n_words", F.posexplode("shingles").alias("offset", "hash"))
        known = each.select("hash").distinct()
        bitmap = spark.sparkContext.broadcast(bitmap_of(known, bitmap_bits))
        rarity = known.join(shingle_counts(docs, text, bitmap, widths), "hash", "left").select("hash", F.coalesce("n", F.lit(0)).alias("n"))
        ordered = each.join(rarity, "hash").groupBy("window", "n_words").agg(F.min(F.struct("n", "hash", "offset")).alias("rarest"))
        self.prefix = scratch.save(ordered.where("rarest.n > 0").select("window", F.col("n_words").alias("width"), "rarest.hash", "rarest.offset"))
        bitmap = spark.sparkContext.broadcast(bitmap_of(self.prefix, bitmap_bits))
        own = docs.select(*dict.fromkeys([*keep, text])).withColumn(self.row, F.monotonically_increasing_id())
        self.marked = scratch.save(places(own, text, bitmap, widths, size, [*keep, self.row], (self.n_words, found)))
        place = self.marked.select(F.col(self.row).alias("row"), F.col(self.n_words).alias("in_text"), F.explode(found).alias("p")).select("row", "in_text", "p.*")
        start = F.col("at") - F.col("offset")
        held = F.array_join(F.slice(F.split("words", " "), F.greatest(F.col("lead") - F.col("offset") + 1, F.lit(1)), F.col("width")), " ")
        self.hits = scratch.save(
            place.join(self.prefix, "hash")
            .where((F.col("lead") >= F.col("offset")) & (start >= 0) & (start + F.col("width") <= F.col("in_text")))
            .where(held == F.col("window"))
            .select("row", start.alias("start"), F.col("width").alias("n_words"), "window"))

    def report(self, doc_id: str = "doc_id") -> DataFrame:
        """(doc_id, n_words, n_hit, n_items, items, contaminated) for each document."""
        from pyspark.sql import Window

        end = F.col("start") + F.col("n_words")
        far = F.max(end).over(Window.partitionBy("row").orderBy("start", "n_words").rowsBetween(Window.unboundedPreceding, -1))
        spans = self.hits.select("row", "start", "n_words").distinct()
        hit = spans.select("row", F.greatest(end - F.greatest("start", F.coalesce(far, F.lit(0))), F.lit(0)).alias("new")).groupBy("row").agg(F.sum("new").alias("n_hit"))
        pairs = self.hits.select("row", "window").distinct().join(self.items.select("window", "item_id").distinct(), "window").select("row", "item_id").distinct()
        items = pairs.groupBy("row").agg(F.sort_array(F.collect_list("item_id")).alias("items"))
        row = F.col("row")
        out = self.marked.select(F.col(self.row).alias("row"), F.col(doc_id).alias("doc_id"), F.col(self.n_words).alias("n_words"))
        out = out.join(hit, "row", "left").join(items, "row", "left")
        none = F.array().cast("array<string>")
        return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(F.coalesce("items", none)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))

    def clean(self, columns: list[str]) -> DataFrame:
        """The rows without a hit."""
        # written first, so that its size is known when the join is planned
        bad = self.scratch.save(self.hits.select(F.col("row").alias(self.row)).distinct())
        return self.marked.join(bad, self.row, "left_anti").select(columns)
