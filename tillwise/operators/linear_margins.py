"""One-vs-rest linear SVMs over sparse texts, all classes and folds in the same passes.

Objective, for each class and each fold that is left out (and once with all texts):
``0.5 |w|^2 + C * sum(max(0, 1 - y w.x))``.  It is solved in the dual (CoCoA: Jaggi
et al. 2014, Ma et al. 2015).  Texts are dealt into blocks of bounded size.  In a
round each block gets the weights of its terms, moves the dual variables of its own
texts by coordinate ascent for all classes and folds at once, and hands back its part
of each weight; a sum by term gives the weights of the next round.  Inside a round the
margins follow each move through the Gram matrix of the block's texts.  Terms are dealt
into parts by their hash: a block sends its weights as one row of numbers for each part,
and a part adds up the rows of all blocks.  So one round is two shuffles of (block, part)
rows, whatever the number of classes x folds: those are the columns of a row's numbers
(``COLUMNS`` at most; further classes are further groups).

A term in K blocks has its square scaled by K inside a block, which bounds what the
blocks do to each other, so no step length is needed; a term of one block stays
there and is not shuffled.  Rounds end when none adds more than ``TOLERANCE`` to the
dual objective of any class and fold (the objective never falls; the duality gap,
kept in ``progress``, bounds what is left).

Terms are their 64-bit hashes; the seed is raised until no two terms of the
vocabulary share one, so every term has a weight of its own.

On ``TermBlocks`` vectors stay inside the blocks of texts, and what all texts of a term
add up to (document frequencies, weights by class) is exchanged between blocks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.operators.term_blocks import Answer, Counted, TermBlocks, classed, counts_of, df_messages, frequencies, in_batches, messages, smooth_idf, spans, sums_by
from tillwise.operators.tfidf import fit_idf, with_idf
from tillwise.sources.sinks import discard, saved

#: Fixed value of the original: weight of a text's loss against the squared weights.
COST = 1.0
#: Largest gain of a last round, as a share of the dual objective, and the rounds that may take.
TOLERANCE, ROUNDS = 0.005, 30
#: Passes over a block's texts in a round.
EPOCHS = 3
#: Terms of texts in a block, and classes x folds side by side: together they bound a task's weights.
BLOCK_TERMS, COLUMNS = 400_000, 32
#: The term that every text has once.
BIAS = 0
#: Texts whose Gram matrix a task holds; a term is dense from one text in ``DENSE``; pairs worked out at once.
SIDE, DENSE, PAIRS = 2048, 10, 1 << 20
OUT = T.StructType([T.StructField("block", T.LongType()), T.StructField("grp", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("part", T.IntegerType()),
                    T.StructField("keys", T.BinaryType()), T.StructField("uses", T.BinaryType()), T.StructField("vec", T.BinaryType()), T.StructField("gap", T.ArrayType(T.DoubleType()))])
_ARROW = pa.schema([("block", pa.int64()), ("grp", pa.int32()), ("kind", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("uses", pa.binary()), ("vec", pa.binary()), ("gap", pa.list_(pa.float64()))])
ALPHA, WEIGHT, GAP = 0, 1, 2


class Vocabulary:
    """Terms of the training texts: (term, t, df, idf) with a hash t that no two share.

    Of ``TermBlocks`` (rows with the flag ``learns``) document frequencies go to the blocks; a repeated row counts again.
    """

    def __init__(self, tf: DataFrame | TermBlocks, n_train: int):
        self.n_train = n_train
        if isinstance(tf, TermBlocks):
            self.replies = tf.exchange(df_messages(tf.parts, lambda own, rows: counts_of(own, rows, "learns")), "vocabulary")
            return
        idf = saved(fit_idf(tf, n_train), "vocabulary")
        seed = 0
        while True:
            self.t = F.xxhash64(F.lit(seed), "term")
            n, distinct, reserved = idf.select(self.t.alias("t")).agg(F.count("t"), F.count_distinct("t"), F.count_if(F.col("t") == BIAS)).first()
            if n == distinct and not reserved:
                break
            seed += 1
        self.idf = idf.withColumn("t", self.t)

    def vectors(self, rows: DataFrame, tf: DataFrame, tasks: int | None = None) -> DataFrame:
        """(row, ts, xs) of every row of ``rows``: tf * idf of its known terms at length one, and the bias.

        Frequent terms join map-side; ``tasks``: parts of the shuffles by term and by row.
        """
        raw = with_idf(tf, self.idf.select("term", "t", "df", "idf"), tasks).select("row", "t", (F.col("tf") * F.col("idf")).alias("x"))
        raw = raw.repartition(tasks, "row") if tasks else raw
        lists = raw.groupBy("row").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"), F.sort_array(F.collect_list(F.struct("t", "x"))).alias("own"))
        known = rows.select("row").join(lists, "row", "left")
        own = F.coalesce("own", F.array().cast(lists.schema["own"].dataType))
        return known.select("row", F.concat(F.transform(own, lambda e: e["t"]), F.array(F.lit(BIAS).cast("long"))).alias("ts"),
                            F.concat(F.transform(own, lambda e: e["x"] / F.col("norm")), F.array(F.lit(1.0))).alias("xs"))


class BlockVectors:
    """Vectors of the texts in blocks (id, text, y, learns, tests): tf * idf of their known terms at length one, and the bias.

    ``sizes``: learning rows of each class, a repeated id's rows once for each of them.
    """

    def __init__(self, blocks: TermBlocks, vocabulary: Vocabulary, sizes: list[int]):
        self.blocks, self.vocabulary, self.sizes = blocks, vocabulary, np.array(sizes, np.float64)

    def class_sums(self) -> DataFrame:
        """For the terms of test texts: the learning rows' sum in each class, and their document frequency as one class more.

        A block leaves out the terms that no other block has, unless it asks for them itself.
        """
        parts, n_train, wide = self.blocks.parts, self.vocabulary.n_train, len(self.sizes) + 1

        def work(block: int, rows: pa.Table, got: pa.Table) -> pa.Table:
            own = Counted(rows)
            df, alone = frequencies(own, parts, got)
            asked = _of_tests(own, rows)
            doc, y, n = classed(own, rows, "learns")
            held, times = np.bincount(doc, minlength=len(own.ids)), counts_of(own, rows, "learns")
            begin, x = np.cumsum(held) - held, _lengths_one(own, df, n_train)
            some = (times[own.doc] > 0) & (asked | ~alone)[own.term]
            term, of = own.term[some], own.doc[some]
            pick = spans(begin[of], held[of])
            key = np.concatenate([np.repeat(term, held[of]) * wide + y[pick], term * wide + wide - 1])
            key, s = sums_by(key, np.concatenate([np.repeat(x[some], held[of]) * (n * times[doc])[pick], times[of]]))
            return messages(block, own, parts, key // wide, key % wide, s, asked)

        return self.blocks.exchange(work, "class-sums", self.vocabulary.replies, kind=np.float64)

    def score(self, sums: DataFrame) -> DataFrame:
        """(row, y, margin) of the test texts, for every class, under the means of ``class_sums``."""
        parts, n_train, sizes = self.blocks.parts, self.vocabulary.n_train, self.sizes
        wide = len(sizes)

        def work(block: int, rows: pa.Table, got: pa.Table) -> pa.Table:
            own = Counted(rows)
            answer = Answer(own, parts, np.ones(own.n, bool), got, np.float64)
            term, y, s = answer.pairs(np.arange(own.n))
            order = np.argsort(y, kind="stable")
            of_class = np.split(order, np.searchsorted(y[order], np.arange(1, wide + 1)))
            df = np.zeros(own.n)
            df[term[of_class[wide]]] = s[of_class[wide]]
            x, margins = _lengths_one(own, df, n_train), np.ones((len(own.ids), wide))  # the bias weighs one in every class
            for c, which in enumerate(of_class[:wide]):
                mean = np.zeros(own.n)
                mean[term[which]] = s[which] / sizes[c]
                margins[:, c] += np.bincount(own.doc, x * mean[own.term], len(own.ids))
            # a repeated row adds itself once for each of its rows
            margins *= np.square(counts_of(own, rows, "tests"))[:, None]
            docs = np.repeat(np.arange(len(own.ids)), wide)
            return in_batches(pa.table({"row": own.ids.take(pa.array(docs)), "y": np.tile(np.arange(wide, dtype=np.int32), len(own.ids)), "margin": margins.ravel()}))

        kind = self.blocks.rows.schema["id"].dataType.simpleString()
        # the terms that a block asked for are those of its test texts, in the same order
        return self.blocks.on(self.blocks.rows.where("tests")).run(work, f"row {kind}, y int, margin double", sums)


def _of_tests(own: Counted, rows: pa.Table) -> np.ndarray:
    """Flags of the terms of test texts."""
    out = np.zeros(own.n, bool)
    out[own.term[counts_of(own, rows, "tests")[own.doc] > 0]] = True
    return out


def _lengths_one(own: Counted, df: np.ndarray, n_train: int) -> np.ndarray:
    """tf * idf of each (term, document) pair of a block at length one; 0 for a term that no learning text has."""
    raw = np.where(df > 0, smooth_idf(df, n_train), 0.0)[own.term] * own.tf
    norm = np.sqrt(np.bincount(own.doc, raw * raw, len(own.ids)))
    return raw / np.where(norm > 0, norm, 1)[own.doc]


def _table(block: int, grp: int, kind: int, part: int = 0, keys=(), uses=(), vec=(), gap=()) -> pa.Table:
    columns = [pa.array([x]) for x in (block, grp, kind, part)]
    columns += [pa.array([np.asarray(x, t).tobytes()], pa.binary()) for x, t in ((keys, np.int64), (uses, np.int32), (vec, np.float64))]
    columns.append(pa.array([list(gap)], pa.list_(pa.float64())))
    return pa.Table.from_arrays(columns, names=OUT.names).cast(_ARROW)


def _numbers(rows: pa.Table, name: str, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), kind) for x in rows[name]]


def spread_terms(keys: np.ndarray, parts: int) -> list[np.ndarray]:
    """Where the keys of each part stand in ``keys`` (ascending)."""
    part = (keys.view(np.uint64) % np.uint64(parts)).astype(np.int64)
    return np.split(np.argsort(part, kind="stable"), np.cumsum(np.bincount(part, minlength=parts))[:-1])


class Block:
    """Texts of a block with the weights and dual variables of a group of classes (columns: class x model)."""

    def __init__(self, left: pa.Table, right: pa.Table, classes: list[int], folds: int):
        left = left.combine_chunks().sort_by("row")
        self.rows = left["row"].to_numpy()
        ts = left["ts"].combine_chunks()
        self.x = left["xs"].combine_chunks().flatten().to_numpy()
        text = np.repeat(np.arange(len(self.rows)), np.asarray(ts.value_lengths()))
        #: All terms of the block, and the places of the texts' terms among them.
        self.terms, self.at = np.unique(ts.flatten().to_numpy(), return_inverse=True)
        y, self.fold = left["y"].to_numpy(), left["fold"].to_numpy()
        cls, model = np.repeat(classes, folds + 1), np.tile(np.arange(-1, folds), len(classes))
        self.sign = np.where(y[:, None] == cls[None, :], 1.0, -1.0)
        #: model -1 learns from all texts, model f from those outside fold f
        self.active = self.fold[:, None] != model[None, :]
        n, width = self.sign.shape
        right = right.sort_by("part")
        kind = right["kind"].to_numpy()
        messages = right.filter(pa.array(kind == WEIGHT))
        alphas = _numbers(right.filter(pa.array(kind == ALPHA)), "vec", np.float64)
        self.alpha = alphas[0].reshape(n, width).copy() if alphas else np.zeros((n, width))
        places = [np.searchsorted(self.terms, keys) for keys in _numbers(messages, "keys", np.int64)]
        spread = np.zeros(len(self.terms))
        for own, uses in zip(places, _numbers(messages, "uses", np.int32), strict=True):
            spread[own] = uses
        # a term that one text alone has adds a fixed share of the text's dual variable to its margin, and to no other
        lone = (np.bincount(self.at, minlength=len(self.terms)) == 1) & (spread == 0)
        kept = ~lone[self.at]
        number = np.cumsum(~lone) - 1
        self.every = (text, self.at, self.x)
        self.lone = np.bincount(text[~kept], self.x[~kept] ** 2, n).astype(np.float64)
        self.text, self.at, self.x, spread = text[kept], number[self.at[kept]], self.x[kept], spread[~lone]
        self.ends = np.r_[0, np.cumsum(np.bincount(self.text, minlength=n))]
        exchanged = spread[self.at] > 0
        self.exchanged = (self.text[exchanged], self.at[exchanged], self.x[exchanged])
        #: Blocks that have each term, lone ones left out.
        self.spread = np.maximum(spread, 1)
        #: Terms that other blocks have too: (part, keys, blocks of each key, place among this block's terms).
        self.shared = [(part, keys, uses, number[own]) for part, keys, uses, own in zip(messages["part"].to_pylist(), _numbers(messages, "keys", np.int64), _numbers(messages, "uses", np.int32), places, strict=True)]
        self.w = self.parts(self.text[~exchanged], self.at[~exchanged], self.x[~exchanged], len(spread))  # a row for each column
        for (_, _, _, own), vec in zip(self.shared, _numbers(messages, "vec", np.float64), strict=True):
            self.w[:, own] = vec.reshape(-1, width).T if len(vec) else 0.0

    def parts(self, text: np.ndarray, at: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        """This block's part of the weights of ``n`` terms, from the terms ``at`` of the texts."""
        signed = (self.alpha * self.sign).T
        return np.array([np.bincount(at, x * v.take(text), n) for v in signed], np.float64).reshape(len(signed), n)

    def margins(self, own=slice(None), entries=slice(None), text: np.ndarray | None = None) -> np.ndarray:
        """Margins of all texts, or of ``own`` with their ``entries``, a row for each column."""
        text = self.text if text is None else text
        at, x = self.at[entries], self.x[entries]
        fixed = (self.alpha[own] * self.sign[own] * self.lone[own, None]).T
        return np.array([np.bincount(text, x * w.take(at), len(v)) + v for w, v in zip(self.w, fixed, strict=True)])

    def gap(self, margins: np.ndarray) -> np.ndarray:
        """This block's part of the duality gap and of the objective, for each column."""
        with_y = margins * self.sign
        loss = COST * np.maximum(0, 1 - with_y) * self.active
        return np.concatenate([(self.alpha * with_y + loss - self.alpha).sum(0), (0.5 * self.alpha * with_y + loss).sum(0)])

    def gram(self, own=slice(None), entries=slice(None), text: np.ndarray | None = None) -> np.ndarray:
        """What a unit move of each text adds to the margin of each other one."""
        text, lone = self.text if text is None else text, self.lone[own]
        n = len(lone)
        order = np.argsort(self.at[entries], kind="stable")
        at, text = self.at[entries][order], text[order]
        scaled = self.x[entries][order] * np.sqrt(self.spread[at])
        begin = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, np.int64)
        held = np.diff(np.r_[begin, len(at)])
        out = np.diag(lone)
        dense = held * DENSE > n  # terms of many texts: columns of a matrix; all others: their pairs of texts
        wide = max(1, PAIRS // max(n, 1))
        for some in np.split(np.flatnonzero(dense), range(wide, int(dense.sum()), wide)):
            pick = _ranges(begin[some], held[some])
            matrix = np.zeros((n, len(some)))
            matrix[text[pick], np.repeat(np.arange(len(some)), held[some])] = scaled[pick]
            out += matrix @ matrix.T
        flat = out.reshape(-1)
        for size in np.unique(held[~dense]).tolist():
            own = begin[~dense & (held == size)]
            many = max(1, PAIRS // size**2)
            for some in np.split(own, range(many, len(own), many)):
                pick = some[:, None] + np.arange(size)
                i, v = text[pick], scaled[pick]
                np.add.at(flat, (i[:, :, None] * n + i[:, None, :]).ravel(), (v[:, :, None] * v[:, None, :]).ravel())
        return out

    def ascend(self, epochs: int, seed: int) -> None:
        """Coordinate ascent on the texts of this block, all columns at once.

        Margins are kept up to date through the Gram matrix of the texts, at most ``SIDE`` at a time.
        """
        order, n = np.random.default_rng(seed), len(self.rows)
        whole = n <= SIDE
        if whole:
            gram, margins = self.gram(), self.margins()
        for _ in range(epochs):
            turns = order.permutation(n)
            if whole:
                self._climb(turns, turns, gram, margins)
                continue
            for own in np.split(turns, range(SIDE, n, SIDE)):
                lens = self.ends[own + 1] - self.ends[own]
                entries, text = _ranges(self.ends[own], lens), np.repeat(np.arange(len(own)), lens)
                before = self.alpha[own]
                self._climb(own, np.arange(len(own)), self.gram(own, entries, text), self.margins(own, entries, text))
                at, scaled = self.at[entries], self.x[entries] * self.spread[self.at[entries]]
                for w, moved in zip(self.w, ((self.alpha[own] - before) * self.sign[own]).T, strict=True):
                    np.add.at(w, at, scaled * moved.take(text))

    def _climb(self, texts: np.ndarray, places: np.ndarray, gram: np.ndarray, margins: np.ndarray) -> None:
        for i, p in zip(texts.tolist(), places.tolist(), strict=True):
            slope = 1 - self.sign[i] * margins[:, p]
            new = np.clip(self.alpha[i] + slope / gram[p, p], 0, COST) * self.active[i]
            move = (new - self.alpha[i]) * self.sign[i]
            moved = np.flatnonzero(move)
            if len(moved):
                row = gram[p]
                for c in moved.tolist():
                    margins[c] += row * move[c]
                self.alpha[i] = new


def _ranges(begin: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each range, one after the other."""
    return np.repeat(begin - np.r_[0, np.cumsum(lens)[:-1]], lens) + np.arange(int(lens.sum())) if len(lens) else np.zeros(0, np.int64)


def _round(classes_of: Callable[[int], list[int]], folds: int, parts: int, number: int | None):
    """The work of a block in round ``number``; None: held-out margins and all weights of the finished model."""
    def work(key, left: pa.Table, right: pa.Table) -> pa.Table:
        block, grp = (k.as_py() for k in key)
        if not len(left):
            return _ARROW.empty_table()
        b = Block(left, right, classes_of(grp), folds)
        margins = b.margins().T
        out = [_table(block, grp, GAP, gap=b.gap(margins))]
        if number is None:
            n = len(b.rows)
            held_out = margins.reshape(n, -1, folds + 1)[np.arange(n), :, b.fold + 1]
            out.append(_table(block, grp, ALPHA, keys=b.rows, vec=held_out))
            whole = b.parts(*b.every, len(b.terms))[:: folds + 1].T
            out += [_table(block, grp, WEIGHT, part, b.terms[own], vec=whole[own]) for part, own in enumerate(spread_terms(b.terms, parts)) if len(own)]
        else:
            b.ascend(EPOCHS, 1_000_003 * number + block)
            out.append(_table(block, grp, ALPHA, vec=b.alpha))
            w = b.parts(*b.exchanged, len(b.spread))
            out += [_table(block, grp, WEIGHT, part, keys, uses, w[:, own].T) for part, keys, uses, own in b.shared]
        return pa.concat_tables(out)

    return work


def _added(rows: pa.Table) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Keys of a part, where those of each row (a block's) stand, and the sum of the rows' vectors by key."""
    keys = _numbers(rows, "keys", np.int64)
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    places = np.split(place, np.cumsum([len(k) for k in keys])[:-1])
    vectors = _numbers(rows, "vec", np.float64)
    total = np.zeros((len(every), len(vectors[0]) // len(keys[0])))
    for own, vec in zip(places, vectors, strict=True):
        total[own] += vec.reshape(len(own), -1)  # a block has a key once
    return every, places, total


def _exchanged(rows: pa.Table) -> pa.Table:
    """The rows of a part (one a block) with the sums over all blocks."""
    rows = rows.sort_by("block")
    _, places, total = _added(rows)
    return rows.set_column(rows.schema.get_field_index("vec"), "vec", pa.array([total[own].tobytes() for own in places], pa.binary()))


def _terms_of(parts: int):
    """A block's terms, a row for each part."""
    def work(texts: pa.Table) -> pa.Table:
        terms = np.unique(texts["ts"].combine_chunks().flatten().to_numpy())
        rows = [_table(texts["block"][0].as_py(), 0, WEIGHT, part, terms[own]) for part, own in enumerate(spread_terms(terms, parts)) if len(own)]
        return pa.concat_tables(rows) if rows else _ARROW.empty_table()

    return work


def _uses(rows: pa.Table) -> pa.Table:
    """The terms of a part that several blocks have, for each block, with the number of blocks."""
    keys = _numbers(rows, "keys", np.int64)
    every, n = np.unique(np.concatenate(keys), return_counts=True)
    out = []
    for block, part, own in zip(rows["block"].to_pylist(), rows["part"].to_pylist(), keys, strict=True):
        uses = n[np.searchsorted(every, own)]
        if (uses > 1).any():
            out.append(_table(block, 0, WEIGHT, part, own[uses > 1], uses[uses > 1]))
    return pa.concat_tables(out) if out else _ARROW.empty_table()


def _whole(rows: pa.Table) -> pa.Table:
    """(grp, t, ws): the weights of a part's terms."""
    every, _, total = _added(rows.sort_by("block"))
    ws = pa.ListArray.from_arrays(np.arange(0, total.size + 1, total.shape[1], dtype=np.int32), pa.array(total.ravel()))
    return pa.table({"grp": pa.array(np.full(len(every), rows["grp"][0].as_py(), np.int32)), "t": pa.array(every), "ws": ws})


def _out_of_fold(first_of: Callable[[int], list[int]]):
    """(row, cls, margin) of a block's texts from its row of numbers."""
    def work(batches):
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            for grp, ids, vec in zip(rows["grp"].to_pylist(), _numbers(rows, "keys", np.int64), _numbers(rows, "vec", np.float64), strict=True):
                classes = first_of(grp)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, len(classes))), pa.array(np.tile(np.array(classes, np.int32), len(ids))), pa.array(vec)], names=["row", "cls", "margin"])

    return work


class Margins:
    """Fitted on ``x`` (row, ts, xs, y, fold): weights (t, cls, w) and out-of-fold margins (row, y, cls, margin).

    ``y`` is the class number of the text (any other number: of no class), ``fold`` 0 to ``folds`` - 1.
    """

    def __init__(self, x: DataFrame, classes: int, folds: int):
        self.classes, self.folds = classes, folds
        per = max(1, COLUMNS // (folds + 1))
        self.groups = -(-classes // per)
        n_terms = x.agg(F.sum(F.size("ts"))).first()[0] or 0
        n_blocks = parts = max(1, -(-n_terms // BLOCK_TERMS))

        def classes_of(grp: int) -> list[int]:
            return list(range(grp * per, min((grp + 1) * per, classes)))

        groups = F.explode(F.sequence(F.lit(0), F.lit(self.groups - 1)))
        dealt = x.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks)))
        # a fixed number of partitions: small blocks are long work, so they must not be put together
        texts = dealt.withColumn("grp", groups).repartition(3 * n_blocks * self.groups, "block", "grp").persist()
        held = texts.where("grp = 0").select("block", "ts").groupBy("block").applyInArrow(_terms_of(parts), OUT)
        uses = saved(held.groupBy("part").applyInArrow(_uses, OUT), "term-blocks").withColumn("grp", groups).select(*OUT.names)

        def messages(last: DataFrame | None) -> DataFrame:
            """Weights of the shared terms and dual variables, as the last round left them."""
            if last is None:
                return uses
            weights = last.where(F.col("kind") == WEIGHT).select(*OUT.names).groupBy("grp", "part").applyInArrow(_exchanged, OUT)
            return weights.unionByName(last.where(F.col("kind") == ALPHA).select(*OUT.names))

        def step(last: DataFrame | None, number: int | None) -> DataFrame:
            work = _round(classes_of, folds, parts, number)
            pair = texts.groupBy("block", "grp").cogroup(messages(last).groupBy("block", "grp"))
            done = saved(pair.applyInArrow(work, OUT), "svm-round", "kind")
            if last is not None:
                discard(last)
            return done

        #: (dual objective, duality gap) of each (class group, column) after each round.
        last, self.progress = None, []
        for number in range(ROUNDS):
            last = step(last, number)
            if number:  # what the weights that the round began with reach
                self.progress.append(self._reached(last))
                if number > 1 and all(now - self.progress[-2][k][0] <= TOLERANCE * now for k, (now, _) in self.progress[-1].items()):
                    break
        done = step(last, None)
        texts.unpersist()
        whole = done.where(F.col("kind") == WEIGHT).select(*OUT.names).groupBy("grp", "part").applyInArrow(_whole, "grp int, t long, ws array<double>")
        whole = whole.select("grp", "t", F.posexplode("ws").alias("pos", "w"))
        #: Weights learnt from all texts.
        self.weights = whole.select("t", (F.lit(per) * F.col("grp") + F.col("pos")).cast("int").alias("cls"), "w")
        own = done.where(F.col("kind") == ALPHA).select("grp", "keys", "vec").mapInArrow(_out_of_fold(classes_of), "row long, cls int, margin double")
        #: Margins of each training text under the models that did not learn from it.
        self.out_of_fold = own.join(x.select("row", "y"), "row").select("row", "y", "cls", "margin")

    @staticmethod
    def _reached(out: DataFrame) -> dict:
        """(class group, column) -> (dual objective, duality gap): one pair a class and fold."""
        parts = out.where(F.col("kind") == GAP).select("grp", (F.size("gap") / 2).cast("int").alias("n"), F.posexplode("gap"))
        sums = parts.groupBy("grp", "n", "pos").agg(F.sum("col").alias("s"))
        pairs = sums.groupBy("grp", (F.col("pos") % F.col("n")).alias("column")).agg(F.min_by("s", "pos").alias("gap"), F.max_by("s", "pos").alias("primal"))
        return {(r["grp"], r["column"]): (r["primal"] - r["gap"], r["gap"]) for r in pairs.collect()}


def score(x: DataFrame | BlockVectors, weights: DataFrame) -> DataFrame:
    """(row, cls, margin) of texts (row, ts, xs) under weights (t, cls, w): sums of x * w over shared terms."""
    if isinstance(x, BlockVectors):
        return x.score(weights)
    pairs = x.select("row", F.explode(F.arrays_zip("ts", "xs")).alias("e")).select("row", F.col("e.ts").alias("t"), F.col("e.xs").alias("x"))
    return pairs.join(weights, "t").groupBy("row", "cls").agg(F.sum(F.col("x") * F.col("w")).alias("margin"))


# --------------------------------------------------------------------------- Platt scaling
def platt_start(margins: DataFrame) -> DataFrame:
    """(cls, a, b, hi, lo): first parameters and smoothed targets from (cls, margin, target)."""
    n = margins.groupBy("cls").agg(F.sum("target").alias("pos"), F.sum(1 - F.col("target")).alias("neg"))
    return n.select("cls", F.lit(0.0).alias("a"), F.log((F.col("neg") + 1) / (F.col("pos") + 1)).alias("b"), ((F.col("pos") + 1) / (F.col("pos") + 2)).alias("hi"), (1 / (F.col("neg") + 2)).alias("lo"))


def platt_step(margins: DataFrame, params: DataFrame) -> DataFrame:
    """``params`` after a Newton step of all classes: five sums for each class."""
    z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("a") * F.col("margin") + F.col("b")))
    rows = margins.join(params, "cls").withColumn("p", 1 / (1 + F.exp(z))).withColumn("miss", F.when(F.col("target") > 0, F.col("hi")).otherwise(F.col("lo")) - F.col("p"))
    m, w = F.col("margin"), F.col("p") * (1 - F.col("p"))
    s = rows.groupBy("cls", "a", "b", "hi", "lo").agg(F.sum(F.col("miss") * m).alias("g1"), F.sum("miss").alias("g2"), (F.sum(w * m * m) + 1e-12).alias("h11"), F.sum(w * m).alias("h12"), (F.sum(w) + 1e-12).alias("h22"))
    det = F.col("h11") * F.col("h22") - F.col("h12") * F.col("h12")
    s = s.withColumn("da", (F.col("h22") * F.col("g1") - F.col("h12") * F.col("g2")) / det).withColumn("db", (F.col("h11") * F.col("g2") - F.col("h12") * F.col("g1")) / det)
    return s.select("cls", (F.col("a") - F.col("da")).alias("a"), (F.col("b") - F.col("db")).alias("b"), "hi", "lo", F.greatest(F.abs("da"), F.abs("db")).alias("step"))


def platt(margins: DataFrame, most: int = 100, close: float = 1e-10) -> DataFrame:
    """(cls, a, b) with P(class) = 1 / (1 + exp(a * margin + b)), fitted for all classes together.

    The driver holds one row of numbers for each class; margins stay on the executors.
    """
    spark = margins.sparkSession
    params = platt_start(margins)
    schema = params.schema
    params = spark.createDataFrame(params.collect(), schema)
    for _ in range(most):
        rows = platt_step(margins, params).collect()
        params = spark.createDataFrame([(r["cls"], r["a"], r["b"], r["hi"], r["lo"]) for r in rows], schema)
        if all(r["step"] < close for r in rows):
            break
    return params.select("cls", "a", "b")
