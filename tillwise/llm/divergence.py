"""How far the sources of a language diverge in the terms they use, by in-mapper stripes.

A term is a run of ASCII letters and characters beyond ASCII; only A-Z are lower-cased.
Each language keeps the terms of at least ``min_docs`` of its documents.

* A stripe is a term of a language with its document frequency and its occurrences
  by source.  Each task folds whole documents into a table of stripes and hands them
  over when it ends, or before that whenever it holds ``ENTRIES`` counts (a spill).
  Texts are never shuffled, and a common term has one stripe for each spill.
* Stripes of a term meet in one partition, sorted, and are added up run by run: a
  task holds a batch and one stripe, however often a term was spilled.
* With N and V known, the merged stripes give all values.  A source without a term
  still has a share of it, the same for all such terms.  So a pair of sources starts
  from the value as if no term occurred (V times the same value), each stripe
  corrects it for the pairs of sources that both have the term, and the number of
  terms by (source, count) corrects it for terms of one of them.  All sums are exact
  decimals, and partial sums go before each shuffle.

A stripe of m sources is corrected for its m * m pairs inside its task, which hands
over one sum for each pair of sources and batch.

Inside, a source of a language goes by a 64-bit hash; the few groups are listed
first, and the hash's seed is raised until no two of them share a value.

Defined results: null text, lang and source count as empty; a group without terms
has the share of an unseen term everywhere; a language without kept terms has
pairs of value 0; repeated rows are documents of their own; an empty table gives an
empty result; a text or a term of any length is taken whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import Scratch, raw_texts

#: Counts that a task holds before it spills its stripes (some 100 bytes each).
ENTRIES = 500_000
#: Bytes of a text that are split into terms at once.
BLOCK = 1 << 20
#: Pairs of sources that share a term, taken at once.
PAIRS = 1 << 20
#: Shares are in units of one in so many.
UNIT = 1_000_000_000
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_NO_TERM = re.compile(rb"[^a-z\x80-\xff]")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
STRIPE = T.StructType([T.StructField("lang", T.StringType()), T.StructField("term", T.StringType()), T.StructField("df", T.LongType()),
                       T.StructField("g", T.ArrayType(T.LongType(), False)), T.StructField("n", T.ArrayType(T.LongType(), False))])

CORRECTION = T.StructType([T.StructField(x, T.LongType()) for x in ("g", "o", "high", "low")])


def terms(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a UTF-8 text in order, in lists of a block each."""
    text = text.translate(_LOWER)
    at = 0
    while at < len(text):
        # a block ends where no term does
        after = _NO_TERM.search(text, at + BLOCK) if at + BLOCK < len(text) else None
        end = len(text) if after is None else after.start()
        yield _TERM.findall(text, at, end)
        at = end


class Stripes:
    """Stripes of a language by column: the document frequency, and the counts of each source."""

    def __init__(self):
        self.df: Counter = Counter()
        self.by: dict[int, Counter] = {}

    def add(self, g: int, text: bytes) -> int:
        """Fold a document; how many counts that adds to the table."""
        mine = self.by.setdefault(g, Counter())
        before = len(mine) + len(self.df)
        seen: set = set()
        for block in terms(text):
            mine.update(block)
            seen.update(block)
        self.df.update(seen)
        return len(mine) + len(self.df) - before

    def rows(self, lang: str, at_once: int = 10_000) -> Iterator[pa.RecordBatch]:
        place = {term: i for i, term in enumerate(self.df)}
        groups = sorted(self.by)
        of = np.concatenate([np.fromiter(map(place.__getitem__, self.by[g]), np.int64, len(self.by[g])) for g in groups])
        n = np.concatenate([np.fromiter(self.by[g].values(), np.int64, len(self.by[g])) for g in groups])
        order = np.argsort(of, kind="stable")
        g = np.repeat(np.array(groups, np.int64), [len(self.by[g]) for g in groups])[order]
        n, ends = n[order], np.r_[0, np.cumsum(np.bincount(of, minlength=len(place)))]
        names, df = list(place), np.fromiter(self.df.values(), np.int64, len(place))
        for a in range(0, len(names), at_once):
            b = min(a + at_once, len(names))
            offsets = (ends[a:b + 1] - ends[a]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x[ends[a]:ends[b]])) for x in (g, n)]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (b - a), pa.string()), pa.array(names[a:b], pa.binary()).cast(pa.string()), pa.array(df[a:b]), *lists], names=STRIPE.names)


def fold(batches: Iterable[pa.RecordBatch], most: int = ENTRIES) -> Iterator[pa.RecordBatch]:
    """Stripes of the documents (g, lang, text) of a task; several of a term if it spills."""
    stripes: dict[str, Stripes] = {}
    entries = 0
    for batch in batches:
        for g, lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw_texts(batch.column(2)), strict=True):
            entries += stripes.setdefault(lang, Stripes()).add(g, text)
            if entries >= most:
                for name, own in stripes.items():
                    yield from own.rows(name)
                stripes, entries = {}, 0
    for name, own in stripes.items():
        yield from own.rows(name)


def _added(rows: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
    """One stripe for each run of rows; runs begin at ``starts``."""
    run = np.zeros(len(rows), np.int64)
    run[starts[1:]] = 1
    run = np.cumsum(run)
    lists = [rows.column(3), rows.column(4)]
    of = np.repeat(run, pc.list_value_length(lists[0]).to_numpy(zero_copy_only=False))
    g, n = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
    order = np.lexsort((g, of))
    of, g, n = of[order], g[order], n[order]
    first = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (g[1:] != g[:-1])]) if len(of) else np.zeros(0, np.int64)
    offsets = np.searchsorted(of[first], np.arange(len(starts) + 1)).astype(np.int32)
    sums = np.add.reduceat(n, first) if len(first) else n
    df = np.add.reduceat(rows.column(2).to_numpy(zero_copy_only=False), starts)
    at = pa.array(starts)
    return pa.RecordBatch.from_arrays([rows.column(0).take(at), rows.column(1).take(at), pa.array(df), pa.ListArray.from_arrays(offsets, pa.array(g[first])), pa.ListArray.from_arrays(offsets, pa.array(sums))], names=STRIPE.names)


def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One stripe a term from stripes sorted by (lang, term)."""
    open_ = None
    for batch in batches:
        if not len(batch):
            continue
        if open_ is not None:
            batch = pa.Table.from_batches([open_.cast(batch.schema), batch]).combine_chunks().to_batches()[0]
        n = len(batch)
        new = np.ones(n, bool)
        if n > 1:
            a, b = (batch.column(0), batch.column(1))
            differs = pc.or_(pc.not_equal(a.slice(1), a.slice(0, n - 1)), pc.not_equal(b.slice(1), b.slice(0, n - 1)))
            new[1:] = differs.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        last = int(starts[-1])
        if len(starts) > 1:
            yield _added(batch.slice(0, last), starts[:-1])
        open_ = _added(batch.slice(last), np.zeros(1, np.int64))
    if open_ is not None:
        yield open_


def corrections(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For stripes (g, p, z lists), what the terms that two sources share add to the pair's value
    beyond the values with an unseen term in either place, summed over a batch."""
    def f(p, q):
        return (p - q) * (p - q) // q

    for batch in batches:
        lens = pc.list_value_length(batch.column(0)).to_numpy(zero_copy_only=False).astype(np.int64)
        names, g = np.unique(batch.column(0).flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        p, z = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (1, 2))
        begins = np.cumsum(lens) - lens
        for a, b in _pieces(lens * lens):
            # every entry of a stripe beside every entry of the same stripe
            wide = np.repeat(lens[a:b], lens[a:b])
            first = np.repeat(np.arange(begins[a], begins[a] + len(wide)), wide)
            step = np.arange(len(first)) - np.repeat(np.cumsum(wide) - wide, wide)
            second = np.repeat(np.repeat(begins[a:b], lens[a:b]), wide) + step
            apart = first != second
            first, second = first[apart], second[apart]
            value = f(p[first], p[second]) - f(p[first], z[second]) - f(z[first], p[second]) + f(z[first], z[second])
            keys, at = np.unique(g[first] * len(names) + g[second], return_inverse=True)
            # halves of 32 bits: their sums over PAIRS values stay exact in doubles
            high, low = (np.bincount(at, x, len(keys)).astype(np.int64) for x in (value >> 32, value & 0xFFFFFFFF))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (names[keys // len(names)], names[keys % len(names)], high, low)], names=CORRECTION.names)


def _pieces(sizes: np.ndarray, most: int = PAIRS) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` in sum; a larger row stands alone."""
    ends = np.cumsum(sizes)
    a = 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
        yield a, b
        a = b


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _share(n: str, m: str) -> str:
    """1 + floor(UNIT * (n + 1) / m), exact; in long arithmetic where that holds."""
    long, wide = f"({UNIT}L * ({n} + 1L)) div {m}", f"(cast({UNIT} as decimal(10,0)) * cast({n} + 1L as decimal(19,0))) div cast({m} as decimal(19,0))"
    return f"(1L + case when {n} < 9000000000L then {long} else {wide} end)"


def _f(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q}))) div ({q})"


class Divergence:
    """Stripes of ``docs`` and the values that follow from them."""

    def __init__(self, docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 3):
        self.docs = docs.select(_text(lang).alias("lang"), _text(source).alias("source"), F.col(text).alias("text"))
        self.min_docs = min_docs
        self.scratch = Scratch(docs.sparkSession, "divergence")
        self._numbered()
        self._counted()

    def _numbered(self) -> None:
        """Groups (lang, source, g) with a hash g that no two share."""
        pairs = self.scratch.save(self.docs.select("lang", "source").distinct())
        seed = 0
        while True:
            self.hash = F.xxhash64(F.lit(seed), "lang", "source")
            seen = pairs.select(self.hash.alias("g")).agg(F.count("g"), F.count_distinct("g")).first()
            if seen[0] == seen[1]:
                break
            seed += 1
        self.pairs = pairs.select("lang", "source", self.hash.alias("g"))

    def _counted(self) -> None:
        rows = self.docs.select(self.hash.alias("g"), "lang", "text").mapInArrow(fold, STRIPE)
        sorted_ = rows.repartition("lang", "term").sortWithinPartitions("lang", "term")
        #: (lang, term, df, g, n) of the kept terms.
        self.stripes = self.scratch.save(sorted_.mapInArrow(merge, STRIPE).where(F.col("df") >= self.min_docs))
        by_group = self.stripes.select(F.explode(F.arrays_zip("g", "n")).alias("e")).groupBy("e.g").agg(F.sum("e.n").alias("total"))
        by_lang = self.stripes.groupBy("lang").agg(F.count("*").alias("v"))
        groups = self.pairs.join(by_group, "g", "left").join(by_lang, "lang", "left").na.fill(0, ["total", "v"])
        # without kept terms no share is asked for; 1 keeps its divisor above zero
        size = F.greatest(F.col("total") + F.col("v"), F.lit(1)).alias("m")
        #: (lang, source, g, total, v, m): occurrences, kept terms of the language, their sum.
        self.groups = self.scratch.save(groups.select("lang", "source", "g", "total", "v", size))
        #: (lang, size, m): m of the language and of each of its groups.
        self.langs = self.groups.groupBy("lang").agg(F.greatest(F.sum("total") + F.max("v"), F.lit(1)).alias("size"), F.map_from_entries(F.collect_list(F.struct("g", "m"))).alias("m"))

    def _entries(self) -> DataFrame:
        """Stripes with the share p of each source that has the term, and its share z of an unseen one."""
        known = self.stripes.join(self.langs, "lang")
        entry = f"transform(arrays_zip(g, n), e -> named_struct('g', e.g, 'n', e.n, 'p', {_share('e.n', 'm[e.g]')}, 'z', {_share('0L', 'm[e.g]')}))"
        return known.select("lang", "term", "size", F.expr(entry).alias("own"))

    def pairs_of_sources(self) -> DataFrame:
        """(lang, source, item, value) for each source and each other one of its language."""
        exact = "cast({} as decimal(38,0))"
        sides = self.groups.select("lang", "g", "v", F.expr(_share("0L", "m")).alias("z"))
        other = sides.select("lang", F.col("g").alias("o"), F.col("z").alias("y"))
        none = sides.join(other, "lang").where("g <> o").selectExpr("g", "o", f"{exact.format('v')} * {exact.format(_f('z', 'y'))} as value")
        counts = self.stripes.select(F.explode(F.arrays_zip("g", "n")).alias("e")).groupBy("e.g", "e.n").agg(F.count("*").alias("terms"))
        counts = counts.join(self.groups.select("lang", "g", "m"), "g").selectExpr("lang", "g", "terms", f"{_share('n', 'm')} as p", f"{_share('0L', 'm')} as z")
        alone = counts.join(other, "lang").where("g <> o")
        first = alone.selectExpr("g", "o", f"{exact.format('terms')} * ({_f('p', 'y')} - {_f('z', 'y')}) as value")
        second = alone.selectExpr("o as g", "g as o", f"{exact.format('terms')} * ({_f('y', 'p')} - {_f('y', 'z')}) as value")
        own = self._entries().select(*(F.col(f"own.{x}").alias(x) for x in "gpz"))
        both = own.mapInArrow(corrections, CORRECTION).groupBy("g", "o").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
        both = both.selectExpr("g", "o", f"{exact.format('high')} * {exact.format(1 << 32)} + {exact.format('low')} as value")
        parts = [x.groupBy("g", "o").agg(F.sum("value").alias("value")) for x in (none, first, second, both)]
        total = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).groupBy("g", "o").agg(F.sum("value").cast("long").alias("value"))
        named = total.join(self.groups.select("lang", "source", "g"), "g").join(self.groups.select(F.col("source").alias("item"), F.col("g").alias("o")), "o")
        return named.select("lang", "source", "item", "value")

    def terms_of_sources(self) -> DataFrame:
        """(lang, source, item, value) for each kept term that a source has more often than its language."""
        known = self._entries().withColumn("q", F.expr(_share("aggregate(own, 0L, (s, e) -> s + e.n)", "size")))
        rows = known.select("term", "q", F.explode("own").alias("e")).where("e.p > q")
        return rows.select(F.col("e.g").alias("g"), F.col("term").alias("item"), F.expr(_f("e.p", "q")).alias("value")).join(self.groups.select("lang", "source", "g"), "g").select("lang", "source", "item", "value")

    def report(self, top: int = 200) -> DataFrame:
        """(lang, source, part, item, value, rank): all pairs, and the ``top`` terms of each source."""
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))

        def ranked(df: DataFrame, part: str) -> DataFrame:
            return df.withColumn("rank", F.row_number().over(order)).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")

        return ranked(self.pairs_of_sources(), "pair").unionByName(ranked(self.terms_of_sources(), "term").where(F.col("rank") <= top))
