"""Repeated byte strings by column-wise suffix sorting of aligned segments.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else is found, in the same document or another.

Column-wise construction inserts one symbol of each string per round and keeps
the order of all suffixes, and the common prefix of neighbours, up to date.
Over whole documents it needs as many rounds as the longest has bytes.  So it
works on short aligned segments here:

1. Each window of ``length`` bytes picks the ``GRAM``-byte string of lowest hash
   in it (the leftmost of equals) as its anchor.  Equal windows pick the same
   string at the same offset, so they only ever need comparing inside a bucket
   of equal anchors, aligned on it.  An anchor's segment spans all windows that
   picked it, at most ``2 * length - GRAM`` bytes.
2. Anchors that occur once in the collection (of distinct texts) are dropped.
3. The others' segments are shuffled by anchor.  Equal segments repeat all over
   and need no comparing.  Different ones go through the rounds: from the last
   column to the first, one symbol of each segment is put before its suffix, the
   order is updated by a stable sort on that symbol, and the common prefix of
   new neighbours is one more than the least between their old places.  A window
   repeats if a neighbour shares ``length`` bytes or more.
4. Anchors in more than ``HOT`` texts do not go to one task.  Their windows are
   counted one by one under the 128-bit digest of their bytes, with partial sums.

Documents, anchors and results between the passes are tables in the shared
folder, written and read in sequence.  Exact copies of a text are found by their
MD5 first: their windows all repeat, and one copy stands for them in the search.

Defined results: a null text counts as empty; texts shorter than ``length`` are
left whole; repeated documents are copies of each other; an empty table gives an
empty result; other columns are left alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import Scratch, blocks, fresh, map_batches, mixed, powers, utf8

LENGTH, GRAM = 400, 64
#: Segments whose columns a task inserts together, and digests that it remembers to send bytes once.
TOGETHER, REMEMBERED = 1 << 14, 1 << 17
#: Texts that an anchor's bucket may have in one task; parts that the rows of one repeated window are dealt to.
HOT, DEALT = 1 << 14, 16
#: Window starts that are hashed at once.
PIECE = 1 << 22


def window_anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of windows with one anchor: (text, first start, last start, anchor's place, its hash).

    Places count from the beginning of ``data[offsets[0]:]``.
    """
    base, out = offsets[0], []
    for a in range(int(base), int(offsets[-1]), PIECE):
        piece = data[a: min(a + PIECE + length - 1, int(offsets[-1]))]
        starts = len(piece) - length + 1
        if starts <= 0:
            continue
        grams = len(piece) - gram + 1
        up, down = powers(len(piece) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * up[: len(piece)], dtype=np.uint64)))
        h = mixed((sums[gram:] - sums[:-gram]) * down[:grams])
        bits = np.uint64(len(piece).bit_length())
        key = (h >> bits << bits) | np.arange(grams, dtype=np.uint64)  # the leftmost of equals
        width = length - gram + 1
        rows = -(-grams // width)
        wide = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
        wide[:grams] = key
        wide = wide.reshape(rows, width)
        ahead = np.minimum.accumulate(wide, axis=1).ravel()
        back = np.minimum.accumulate(wide[:, ::-1], axis=1)[:, ::-1].ravel()
        at = (np.minimum(back[:starts], ahead[width - 1: width - 1 + starts]) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        begin = np.arange(a, a + starts)
        text = np.searchsorted(offsets, begin, "right") - 1
        inside = begin + length <= offsets[text + 1]
        new = np.concatenate(([True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])))
        # windows that reach into the next text break runs off
        new |= np.concatenate(([True], inside[1:] != inside[:-1]))
        first = np.flatnonzero(new)
        last = np.append(first[1:], starts) - 1
        real = inside[first]
        first, last = first[real], last[real]
        out.append((text[first], begin[first] - base, begin[last] - base, at[first] + a - base, h[at[first]].view(np.int64)))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def repeated_starts(columns: np.ndarray, begin: np.ndarray, end: np.ndarray, bucket: np.ndarray, length: int) -> np.ndarray:
    """For each segment and column: does a window that starts there repeat in its bucket?

    ``columns``: a row for each segment, aligned on its bucket's anchor; its
    symbols stand from ``begin`` to ``end``; ``bucket`` is sorted.
    """
    n, width = columns.shape
    order = np.arange(n)
    shared = np.zeros(n + 1, np.int32)  # common prefix with the one before, in order
    found = np.zeros((n, width), bool)
    border = np.concatenate(([True], bucket[1:] != bucket[:-1]))
    part = np.cumsum(border).astype(np.int64) * 512
    for c in range(width - 1, -1, -1):
        there = (begin <= c) & (c < end)
        symbol = np.where(there, columns[:, c].astype(np.int64), 256)[order]
        key = part[order] + symbol
        perm = np.argsort(key, kind="stable")
        key, order = key[perm], order[perm]
        same = (key[1:] == key[:-1]) & (symbol[perm[1:]] < 256)
        near = np.zeros(n + 1, np.int32)
        one = np.flatnonzero(same & (perm[1:] == perm[:-1] + 1))
        near[one + 1] = shared[perm[one + 1]] + 1
        far = np.flatnonzero(same & (perm[1:] != perm[:-1] + 1))
        if len(far):  # the least between the old places
            spans = np.stack((perm[far] + 1, perm[far + 1] + 1), axis=1).ravel()
            near[far + 1] = np.minimum.reduceat(shared, spans)[::2] + 1
        shared = near
        if c + length <= width:
            both = np.maximum(shared[:-1], shared[1:]) >= length
            found[order[both], c] = True
    return found


def runs(mask: np.ndarray) -> np.ndarray:
    """(first, past the last) of each run of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return edge.reshape(-1, 2)


def united(spans: np.ndarray) -> np.ndarray:
    """Disjoint spans in order, touching ones joined."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    far = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate(([True], spans[1:, 0] > far[:-1]))
    at = np.flatnonzero(new)
    return np.stack((spans[at, 0], np.append(far[at[1:] - 1], far[-1])), axis=1)


class _Bucketed:
    """Takes segment rows sorted by (anchor, digest) and gives the covered spans (row, start, end)."""

    def __init__(self, length: int, gram: int):
        self.length, self.left = length, length - gram
        self.spans: list[tuple[int, int, int]] = []
        self.held: list[tuple] = []  # different segments of whole buckets
        self.open: list[tuple] = []  # of the bucket that goes on
        self.anchor = None

    def add(self, anchor, digest, row, lo, lead, size, raw) -> None:
        if digest is None:  # covered already, by a repetition in the text
            self.spans.append((row, lo, lo + size))
            return
        if anchor != self.anchor:
            self.close()
            self.anchor = anchor
        last = self.open[-1] if self.open else None
        if last is not None and last[0] == digest:
            if not last[5]:
                last[5] = True
                self.spans.append((last[1], last[2], last[2] + last[4]))
            self.spans.append((row, lo, lo + size))
            if last[6] is None:
                last[6] = raw
        else:
            self.open.append([digest, row, lo, lead, size, False, raw])

    def close(self) -> None:
        if len(self.open) > 1:
            self.held += [(self.anchor, *x) for x in self.open]
        self.open = []
        if len(self.held) >= TOGETHER:
            self.sort_out()

    def sort_out(self) -> None:
        held, self.held = self.held, []
        if not held:
            return
        width = self.left + self.length
        columns = np.zeros((len(held), width), np.uint8)
        begin = np.array([self.left - x[4] for x in held])
        end = begin + np.array([x[5] for x in held])
        for k, x in enumerate(held):
            columns[k, begin[k]: end[k]] = np.frombuffer(x[7], np.uint8)
        found = repeated_starts(columns, begin, end, np.array([x[0] for x in held]), self.length)
        for k in np.flatnonzero(found.any(axis=1)):
            x = held[k]
            if not x[6]:
                zero = x[3] - int(begin[k])
                self.spans += [(x[2], zero + int(a), zero + int(b) - 1 + self.length) for a, b in runs(found[k])]

    def taken(self) -> pa.RecordBatch:
        spans, self.spans = self.spans, []
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in spans], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int64()))], names=["row", "start", "end"])


SEGMENT = "anchor long, digest binary, row long, lo long, lead int, size int, raw binary"


class RepeatedStrings:
    """Finds the repeated strings of every text of ``df``.

    ``marked``: the kept columns, the text, ``row`` (an id of the row);
    ``spans``: (row, spans): the covered bytes of each row that has any.
    """

    def __init__(self, df: DataFrame, text: str = "text", keep: list[str] | None = None, length: int = LENGTH, gram: int = GRAM):
        self.length, self.text = length, text
        self.keep = df.columns if keep is None else keep
        self.scratch = scratch = Scratch(df.sparkSession, "repeats")
        self.row, digest, anchors = (fresh(df, x) for x in ("row", "digest", "anchors"))
        whole = F.coalesce(F.col(text), F.lit(""))
        own = df.select(*dict.fromkeys([*self.keep, text]))
        own = own.withColumns({self.row: F.monotonically_increasing_id(), digest: F.unhex(F.md5(whole.cast("binary")))})
        self.marked = scratch.save(self._with_anchors(own, anchors, gram))
        row = F.col(self.row).alias("row")
        copies = scratch.save(self.marked.groupBy(F.col(digest).alias("digest")).agg(F.count("*").alias("n"), F.min(self.row).alias("row")))
        each = self.marked.select(row, F.explode(anchors).alias("anchor")).join(copies.select("row"), "row", "left_semi")
        twice = each.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor", (F.col("n") > HOT).alias("is_hot"))
        lists = (F.collect_list(F.when(x, F.col("anchor"))) for x in (~F.col("is_hot"), F.col("is_hot")))
        wanted = scratch.save(each.join(twice, "anchor").distinct().groupBy("row").agg(*(x.alias(name) for x, name in zip(lists, ("wanted", "hot"), strict=True))))
        texts = self.marked.select(row, F.col(text).alias("text")).join(wanted, "row")
        self.segments = self._segments(texts, gram)
        spans = self.segments.repartition("anchor").sortWithinPartitions("anchor", "digest").mapInArrow(self._bucketed(gram), "row long, start long, end long")
        if not wanted.where(F.size("hot") > 0).isEmpty():
            spans = spans.union(self._hot_spans(texts.where(F.size("hot") > 0), gram))
        # all bytes of a text with copies are covered; -1: up to its end
        again = self.marked.select(row, F.col(digest).alias("digest")).join(copies.where("n > 1").select("digest"), "digest")
        spans = spans.union(again.select("row", F.lit(0).cast("long"), F.lit(-1).cast("long")))
        self.spans = scratch.save(spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans")))

    def _with_anchors(self, own: DataFrame, anchors: str, gram: int) -> DataFrame:
        """Append each text's anchors, those that occur more than once in it twice."""
        from pyspark.sql import types as T

        text, length = self.text, self.length

        def add(batch):
            data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
            ends, values = [np.zeros(1, np.int64)], []
            for i, j in blocks(offsets):
                of, _, _, _, h = window_anchors(data, offsets[i: j + 1], length, gram)
                order = np.lexsort((h, of))
                of, h = of[order], h[order]
                same = np.concatenate(([False], (of[1:] == of[:-1]) & (h[1:] == h[:-1])))
                third = same & np.concatenate(([False], same[:-1]))
                values.append(h[~third])
                ends.append(ends[-1][-1] + np.cumsum(np.bincount(of[~third], minlength=j - i)))
            return [pa.ListArray.from_arrays(pa.array(np.concatenate(ends), pa.int32()), pa.array(np.concatenate([*values, np.zeros(0, np.int64)])))]

        return map_batches(own, add, [T.StructField(anchors, T.ArrayType(T.LongType()))])

    def _segments(self, texts: DataFrame, gram: int) -> DataFrame:
        """Segments of the wanted anchors; a digest's bytes go out once for each task."""
        length = self.length

        def cut(batches):
            sent: set[bytes] = set()
            for batch in batches:
                data, offsets = utf8(batch.column(1))
                ids, wanted = batch.column(0).to_pylist(), batch.column(2)
                for i, j in blocks(offsets):
                    of, first, last, at, h = window_anchors(data, offsets[i: j + 1], length, gram)
                    cuts = np.searchsorted(of, np.arange(j - i + 1))
                    out: list[tuple] = []
                    for t in range(j - i):
                        own = slice(int(cuts[t]), int(cuts[t + 1]))
                        pick = np.flatnonzero(np.isin(h[own], wanted[i + t].values.to_numpy(zero_copy_only=False))) + own.start
                        zero = int(offsets[i + t] - offsets[i])
                        seen: dict[bytes, list] = {}
                        for k in pick.tolist():
                            a, b = int(first[k]), int(last[k]) + length
                            raw = data[offsets[i] + a: offsets[i] + b].tobytes()
                            seen.setdefault(hashlib.md5(raw).digest(), [raw, int(h[k]), int(at[k]) - a]).append(a - zero)
                        again = []
                        for digest, (raw, anchor, lead, *places) in seen.items():
                            out.append((anchor, digest, ids[i + t], places[0], lead, len(raw), None if digest in sent else raw))
                            sent.add(digest)
                            if len(places) > 1:
                                again += [(p, p + len(raw)) for p in places]
                        out += [(None, None, ids[i + t], int(a), 0, int(b - a), None) for a, b in united(np.array(again, np.int64).reshape(-1, 2))]
                    if len(sent) > REMEMBERED:
                        sent.clear()
                    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], kind) for c, kind in enumerate(kinds)], names=[f.split()[0] for f in SEGMENT.split(", ")])

        return texts.select("row", "text", "wanted").mapInArrow(cut, SEGMENT)

    def _hot_spans(self, texts: DataFrame, gram: int) -> DataFrame:
        """(row, start, end) of the repeated windows of hot anchors; equal windows have equal anchors."""
        length = self.length

        def cut(batches):
            for batch in batches:
                data, offsets = utf8(batch.column(1))
                ids, hot = batch.column(0).to_pylist(), batch.column(2)
                for i, j in blocks(offsets):
                    of, first, last, _, h = window_anchors(data, offsets[i: j + 1], length, gram)
                    cuts = np.searchsorted(of, np.arange(j - i + 1))
                    for t in range(j - i):
                        own = slice(int(cuts[t]), int(cuts[t + 1]))
                        pick = np.flatnonzero(np.isin(h[own], hot[i + t].values.to_numpy(zero_copy_only=False))) + own.start
                        zero = int(offsets[i + t])
                        whole = data[zero: int(offsets[i + t + 1])].tobytes()
                        starts = [int(offsets[i]) - zero + a for k in pick.tolist() for a in range(int(first[k]), int(last[k]) + 1)]
                        for a in range(0, len(starts), PIECE >> 8):
                            some = starts[a: a + (PIECE >> 8)]
                            digests = [hashlib.md5(whole[x: x + length]).digest() for x in some]
                            yield pa.RecordBatch.from_arrays([pa.array([ids[i + t]] * len(some), pa.int64()), pa.array(some, pa.int64()), pa.array(digests, pa.binary())], names=["row", "start", "digest"])

        windows = texts.select("row", "text", "hot").mapInArrow(cut, "row long, start long, digest binary")
        part = F.pmod(F.xxhash64("row", "start"), F.lit(DEALT))
        again = windows.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(DEALT - 1).cast("long"))).alias("part"))
        return windows.withColumn("part", part).join(again, ["digest", "part"]).select("row", "start", (F.col("start") + length).alias("end"))

    def _bucketed(self, gram: int):
        length = self.length

        def run(batches):
            buckets = _Bucketed(length, gram)
            for batch in batches:
                for x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    buckets.add(*x)
                yield buckets.taken()
            buckets.close()
            buckets.sort_out()
            yield buckets.taken()

        return run

    def stripped(self, kept: str = "kept", removed: str = "removed") -> DataFrame:
        """The kept columns, the text's bytes without the covered ones, and the removed spans."""
        from pyspark.sql import types as T

        spans, row, text, length = fresh(self.marked, "spans"), self.row, self.text, self.length
        joined = self.marked.select(*dict.fromkeys([*self.keep, text, row])).join(self.spans.select(F.col("row").alias(row), F.col("spans").alias(spans)), row, "left")
        span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])

        def strip(batch):
            data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
            column = batch.column(batch.schema.get_field_index(spans))
            left, gone = [], []
            for t, found in enumerate(column.to_pylist()):
                a, b = int(offsets[t]), int(offsets[t + 1])
                size = b - a
                own = [(x["start"], size if x["end"] < 0 else x["end"]) for x in found or [] if x["end"] >= 0 or size >= length]
                own = united(np.array(own, np.int64).reshape(-1, 2))
                at, parts = a, []
                for x, y in own.tolist():
                    parts.append(data[at: a + x].tobytes())
                    at = a + y
                parts.append(data[at: b].tobytes())
                left.append(b"".join(parts))
                gone.append([{"start": x, "end": y} for x, y in own.tolist()])
            return [pa.array(left, pa.binary()), pa.array(gone, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]

        return map_batches(joined, strip, [T.StructField(kept, T.BinaryType()), T.StructField(removed, T.ArrayType(span))], self.keep)
