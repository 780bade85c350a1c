"""Term counts of texts dealt into blocks, and sums over all texts exchanged term by term.

A block is the texts of so many ids (``BLOCK_BYTES`` of text on average), and all texts of
an id are in one block.  A (document, term) row exists inside a block only: where a job
needs a sum over all texts for a term (document frequency, occurrences by label, weight by
class), each block sends its own part of the sum once for each of its distinct terms, the
terms being dealt into parts by their hash, and a part sends back the whole sums of the terms
that a block asks for.  A message is one row for a block and a part: the terms as compressed
lines in ascending order, the numbers as compressed arrays.  So the texts, not their terms, are
shuffled for each exchange; shuffles are deleted when an exchange is done.

Terms are those of ``functions.text.terms``: tokens come from it, stop words and bigrams are
worked out on token numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.text import STOP_WORDS, tokens
from tillwise.sources.sinks import saved

#: Bytes of text in a block, blocks for each part of the terms, and rows that a task hands on at once.
BLOCK_BYTES, BLOCKS_PER_PART, ROWS = 8 << 20, 2, 1 << 16
#: Spark's setting to delete the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: ``block`` of the rows with a part's totals: one for each column, and one (column -1) with its number of summed terms.
TOTALS = -1
MESSAGE = "block long, part int, terms binary, places binary, columns binary, values binary, asked binary"
REPLY = "block long, part int, column int, total long, held binary, columns binary, values binary, alone binary"


@contextmanager
def without_old_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that end in here leave no shuffle files."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def packed(numbers: np.ndarray) -> bytes:
    return len(numbers).to_bytes(8, "little") + pa.compress(numbers.tobytes(), "zstd", asbytes=True)


def unpacked(raw: bytes, kind: type) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little") * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(raw[8:], n, "zstd"), kind)


def sums_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``keys``, ascending, and the sum of the ``values`` of each (whole numbers stay exact)."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(values[order], first) if len(keys) else values[:0]


def spans(begin: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each range, one after the other."""
    return np.repeat(begin - (np.cumsum(lens) - lens), lens) + np.arange(int(lens.sum()))


class Counted:
    """The terms of a block: for each distinct (term, document) pair, ascending, how often it occurs.

    ``ids``: the documents (rows of an id are one); ``place``: each row's document;
    ``term``, ``doc``, ``tf``: the pairs; ``n``: distinct terms.
    """

    def __init__(self, rows: pa.Table):
        ids = rows["id"].combine_chunks().dictionary_encode(null_encoding="encode")
        self.ids, self.place = ids.dictionary, ids.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lists = rows["tokens"].combine_chunks()
        text = np.repeat(np.arange(len(lists)), pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False))
        words = lists.flatten().dictionary_encode()
        order = pc.sort_indices(words.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        #: Tokens, ascending: a term's number depends on the block's set of tokens alone.
        self.words = words.dictionary.take(pa.array(order))
        code = rank[words.indices.to_numpy()]
        kept = ~pc.is_in(self.words, value_set=pa.array(STOP_WORDS)).to_numpy(zero_copy_only=False)[code]
        code, text = code[kept], text[kept]
        pair, wide, docs = text[1:] == text[:-1], len(order), max(len(self.ids), 1)
        key = np.concatenate([code, wide + code[:-1][pair] * wide + code[1:][pair]])
        doc = self.place[np.concatenate([text, text[1:][pair]])]
        del lists, words, code, text, kept, pair
        if (wide + 1) * wide * docs < 1 << 63:
            key *= docs
            key += doc
            del doc
            both, self.tf = np.unique(key, return_counts=True)
            key, self.doc = both // docs, both % docs
            del both
        else:
            distinct, dense = np.unique(key, return_inverse=True)
            both, self.tf = np.unique(dense * docs + doc, return_counts=True)
            key, self.doc = distinct[both // docs], both % docs
        new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
        self.keys, self.term = key[new], np.cumsum(new) - 1
        self.n, self._parts = len(self.keys), None

    def lines(self, which: np.ndarray, end: str = "") -> pa.Array:
        """Terms by their numbers, each with ``end``."""
        wide = len(self.words)
        keys = self.keys[which]
        one, out = keys < wide, np.empty(len(keys), np.int64)
        out[one], out[~one] = np.arange(one.sum()), one.sum() + np.arange((~one).sum())
        both = keys[~one] - wide
        ended = pc.binary_join_element_wise(self.words, end, "") if end else self.words
        two = pc.binary_join_element_wise(self.words.take(pa.array(both // max(wide, 1))), ended.take(pa.array(both % max(wide, 1))), " ")
        return pa.concat_arrays([ended.take(pa.array(keys[one])), two]).take(pa.array(out))

    def parts(self, parts: int) -> np.ndarray:
        """Each term's part: it depends on the term's text alone."""
        if self._parts is not None:
            return self._parts
        wide = len(self.words)
        own = np.fromiter(map(zlib.crc32, self.words.cast(pa.binary()).to_pylist()), np.uint64, wide)
        one = self.keys < wide
        h = np.empty(self.n, np.uint64)
        h[one] = own[self.keys[one]]
        both = self.keys[~one] - wide
        h[~one] = own[both // max(wide, 1)] * np.uint64(0x9E3779B97F4A7C15) + own[both % max(wide, 1)] + np.uint64(1)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        self._parts = ((h ^ (h >> np.uint64(32))) % np.uint64(parts)).astype(np.int32)
        return self._parts


def messages(block: int, own: Counted, parts: int, term: np.ndarray, column: np.ndarray, value: np.ndarray, asked: np.ndarray) -> pa.Table:
    """Rows of MESSAGE: ``value`` of each (term, column) pair (ascending by term), and which terms the block asks for (a flag each)."""
    part = own.parts(parts)
    given = np.zeros(own.n, bool)
    given[term] = True
    sent = np.flatnonzero(given | asked)
    sent = sent[np.argsort(part[sent], kind="stable")]
    lines = own.lines(sent, "\n")
    offsets, data = lines.buffers()[1:]
    offsets = np.frombuffer(offsets, np.int32)[lines.offset: lines.offset + len(lines) + 1] if len(lines) else np.zeros(1, np.int32)
    data = memoryview(data) if data is not None else b""
    cuts = np.r_[0, np.cumsum(np.bincount(part[sent], minlength=parts))]
    where = np.empty(own.n, np.int64)
    where[sent] = np.arange(len(sent))
    order = np.argsort(where[term], kind="stable")
    at, column, value = where[term][order], column[order].astype(np.int32), value[order]
    ends = np.searchsorted(at, cuts)
    columns: list[list] = [[] for _ in range(7)]
    for p in np.flatnonzero(np.diff(cuts)).tolist():
        i, j, a, b = cuts[p], cuts[p + 1], ends[p], ends[p + 1]
        raw = bytes(data[offsets[i]: offsets[j]])
        row = [block, p, len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True), packed(np.diff(at[a:b] - i, prepend=0).astype(np.int32)), packed(column[a:b]), packed(value[a:b]), packed(asked[sent[i:j]])]
        for x, values in zip(row, columns, strict=True):
            values.append(x)
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 5]
    return pa.Table.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["block", "part", "terms", "places", "columns", "values", "asked"])


def _lines(raw: list[bytes]) -> list[pa.Array]:
    """The terms of each message."""
    out = []
    for x in raw:
        data = pa.decompress(x[8:], int.from_bytes(x[:8], "little"), "zstd")
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10).astype(np.int32) + 1
        out.append(pa.StringArray.from_buffers(len(ends), pa.py_buffer(np.r_[np.int32(0), ends].astype(np.int32)), data))
    return out


def replies(kind: type, totals: bool) -> Callable[[pa.Table], pa.Table]:
    """The work of a part: sums by (term, column) over the messages of all blocks, and each block's asked ones.

    A reply has, for each asked term in order, the number of columns with a sum, those columns and sums, and whether no other block has the term.
    """
    def work(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        lines = pa.chunked_array(_lines(rows["terms"].to_pylist()), pa.string())
        cuts = np.r_[0, np.cumsum([len(x) for x in lines.chunks])]
        codes = np.concatenate([x.indices.to_numpy() for x in lines.dictionary_encode().chunks])
        del lines
        blocks_of = np.bincount(codes)
        given = [np.cumsum(unpacked(x, np.int32), dtype=np.int64) for x in rows["places"].to_pylist()]
        column = np.concatenate([unpacked(x, np.int32) for x in rows["columns"].to_pylist()]).astype(np.int64)
        value = np.concatenate([unpacked(x, kind) for x in rows["values"].to_pylist()])
        code = np.concatenate([codes[a + x] for a, x in zip(cuts, given, strict=False)]).astype(np.int64)
        wide = int(column.max(initial=0)) + 1
        key, total = sums_by(code * wide + column, value)
        held = np.bincount(key // wide, minlength=len(blocks_of))
        begin = np.cumsum(held) - held
        column = key % wide
        out: list[list] = [[] for _ in range(8)]
        part = rows["part"][0].as_py()
        for block, a, asked in zip(rows["block"].to_pylist(), cuts.tolist(), rows["asked"].to_pylist(), strict=False):
            asked = unpacked(asked, bool)
            if not asked.any():
                continue
            own = codes[a: a + len(asked)][asked]
            pick = spans(begin[own], held[own])
            row = [block, part, None, None, packed(held[own].astype(np.int32)), packed(column[pick].astype(np.int32)), packed(total[pick]), packed(blocks_of[own] == 1)]
            for x, values in zip(row, out, strict=True):
                values.append(x)
        if totals:
            which, sums = sums_by(column, total)
            for c, n in [(-1, int((held > 0).sum())), *zip(which.tolist(), sums.tolist(), strict=True)]:
                for x, values in zip([TOTALS, part, c, int(n), *[None] * 4], out, strict=True):
                    values.append(x)
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
        return pa.Table.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["block", "part", "column", "total", "held", "columns", "values", "alone"])

    return work


def counts_of(own: Counted, rows: pa.Table, flag: str) -> np.ndarray:
    """How many rows of each document have the flag."""
    return np.bincount(own.place[pc.fill_null(rows[flag].combine_chunks(), False).to_numpy(zero_copy_only=False)], minlength=len(own.ids))


def classed(own: Counted, rows: pa.Table, flag: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, class ``y``, rows) of the rows with the flag, ascending."""
    some = pc.fill_null(rows[flag].combine_chunks(), False).to_numpy(zero_copy_only=False)
    y = rows["y"].combine_chunks().fill_null(0).to_numpy(zero_copy_only=False)[some].astype(np.int64)
    wide = int(y.max(initial=0)) + 1
    key, n = np.unique(own.place[some] * wide + y, return_counts=True)
    return key // wide, key % wide, n


class Answer:
    """What a block got back: of its asked terms (numbers, a flag each in ``asked``) the columns and sums of each, and ``alone``."""

    def __init__(self, own: Counted, parts: int, asked: np.ndarray, rows: pa.Table, kind: type):
        rows = rows.sort_by("part")
        part = own.parts(parts)
        terms = np.flatnonzero(asked)
        terms = terms[np.argsort(part[terms], kind="stable")]
        read = lambda name, kind: np.concatenate([np.zeros(0, kind), *(unpacked(x, kind) for x in rows[name].to_pylist())])
        held = read("held", np.int32).astype(np.int64)
        if len(held) != len(terms):
            raise ValueError("a block's terms changed between two passes")
        #: Columns with a sum of each term, and where they begin in ``column`` and ``value``.
        self.held, self.begin, self.alone = np.zeros(own.n, np.int64), np.zeros(own.n, np.int64), np.zeros(own.n, bool)
        self.held[terms], self.begin[terms], self.alone[terms] = held, np.cumsum(held) - held, read("alone", bool)
        self.column, self.value = read("columns", np.int32).astype(np.int64), read("values", kind)

    def pairs(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each (term, column) with a sum: place in ``term``, column, sum."""
        held = self.held[term]
        pick = spans(self.begin[term], held)
        return np.repeat(np.arange(len(term)), held), self.column[pick], self.value[pick]


def _freed(out: pa.Table) -> pa.Table:
    """``out``, when what the block's work no longer needs is given back: a worker has one block after the other."""
    pa.default_memory_pool().release_unused()
    return out


class TermBlocks:
    """Texts (id, text and further columns) dealt into blocks by id."""

    def __init__(self, rows: DataFrame, blocks: int | None = None):
        self.blocks = blocks or 1 + (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES
        self.parts = 1 + self.blocks // BLOCKS_PER_PART
        self.rows = rows

    def on(self, rows: DataFrame) -> TermBlocks:
        """As many blocks with other columns of the same texts."""
        return TermBlocks(rows, self.blocks)

    def texts(self) -> DataFrame:
        """The rows by block with their tokens; texts are shuffled and sorted, tokens are not."""
        dealt = self.rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(self.blocks))).repartition(self.blocks, "block").sortWithinPartitions("block")
        return dealt.withColumn("tokens", tokens(F.col("text"))).drop("text")

    def run(self, work: Callable, schema: str, *last: DataFrame) -> DataFrame:
        """``work(block, rows, *replies)`` of each block, with the block's replies of each exchange in ``last``."""
        texts = self.texts().groupBy("block")
        if not last:
            return texts.applyInArrow(lambda key, rows: _freed(work(key[0].as_py(), rows)), schema)
        steps = range(len(last))
        answers = reduce(DataFrame.unionByName, (x.where(F.col("block") != TOTALS).withColumn("step", F.lit(k)) for k, x in enumerate(last)))
        answers = answers.repartition(self.blocks, "block").groupBy("block")
        return texts.cogroup(answers).applyInArrow(lambda key, rows, got: _freed(work(key[0].as_py(), rows, *(got.filter(pc.equal(got["step"], k)) for k in steps))), schema)

    def exchange(self, work: Callable, name: str, *last: DataFrame, kind: type = np.int64, totals: bool = False) -> DataFrame:
        """Replies to the messages of all blocks (``work`` makes a block's), written in the shared folder."""
        sent = self.run(work, MESSAGE, *last)
        with without_old_shuffles(sent.sparkSession):
            return saved(sent.repartition(self.parts, "part").groupBy("part").applyInArrow(replies(kind, totals), REPLY), name)


def in_batches(table: pa.Table) -> pa.Table:
    """The same rows, handed on in pieces of bounded size."""
    return pa.Table.from_batches(table.to_batches(max_chunksize=ROWS), table.schema)


def df_messages(parts: int, counts: Callable[[Counted, pa.Table], np.ndarray] | None = None) -> Callable:
    """Work of a block that sends its document frequencies and asks for those of all its terms.

    ``counts``: how often each document counts (once without it).
    """
    def work(block: int, rows: pa.Table) -> pa.Table:
        own = Counted(rows)
        term, df = (own.term, np.ones(len(own.term), np.int64)) if counts is None else (own.term, counts(own, rows)[own.doc])
        some = df > 0
        term, df = sums_by(term[some], df[some])
        return messages(block, own, parts, term, np.zeros(len(term), np.int32), df, np.ones(own.n, bool))

    return work


def frequencies(own: Counted, parts: int, got: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Document frequency of each term of a block (0: in no counted document), and whether no other block has it."""
    answer = Answer(own, parts, np.ones(own.n, bool), got, np.int64)
    place, _, value = answer.pairs(np.arange(own.n))
    df = np.zeros(own.n, np.int64)
    df[place] = value
    return df, answer.alone


def smooth_idf(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.log((1 + n_docs) / (1 + df)) + 1
