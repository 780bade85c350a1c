"""TF-IDF in long form (T5, A18): ``(doc_id, term, tf, df, idf, weight)``.

idf = ln((1 + N) / (1 + df)) + 1 (smoothed, the +1 keeps terms present in
every document), weight = tf * idf, then L2-normalised per document.

Plan: deal the texts by id, a bounded number of bytes a task -> explode terms and
count them there ((doc, term) rows are never shuffled for it) -> document frequency per term (partial aggregation again, so a term present in
every document is combined before the shuffle) -> weights.  Terms on more than
one (doc, term) row in ``SHARE`` are frequent; there are fewer than ``SHARE`` of
them whatever the corpus, so they go to the tasks as a map-side table and their
rows never shuffle on the term.  All other terms join by a shuffle in which no
key holds more than that share.  Norms are a window over the rows of a document.

On ``TermBlocks`` (texts dealt into blocks) no (doc, term) row is shuffled or written: blocks
exchange document frequencies term by term, and weights are worked out where the texts are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.operators.term_blocks import Counted, TermBlocks, df_messages, frequencies, in_batches, smooth_idf

#: A term on more than one (doc, term) row in so many is frequent.
SHARE = 1024
#: Bytes of text whose terms one task counts: its (doc, term) groups stay in memory.
BYTES_PER_TASK = 4 << 20


def text_tasks(docs: DataFrame, text_col: str = "text") -> int:
    """Tasks for the terms of all texts; one pass over the texts' lengths."""
    return 1 + (docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0) // BYTES_PER_TASK


def term_counts(docs: DataFrame, id_col: str, terms_col, tasks: int | None = None) -> DataFrame:
    """(doc_id, term, tf) from a column of term arrays.

    With ``tasks`` (``text_tasks``) the texts are shuffled by id into so many parts, each far
    smaller than its terms, and counted where they land; without, the terms are shuffled.
    """
    docs = docs.repartition(tasks, id_col) if tasks else docs
    return (docs.select(F.col(id_col).alias("doc_id"), F.explode(terms_col).alias("term"))
            .groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf")))


class BlockIdf:
    """Document frequencies as the blocks asked for them, and the fitting corpus size."""

    def __init__(self, blocks: TermBlocks, n_docs: int):
        self.replies, self.n_docs = blocks.exchange(df_messages(blocks.parts), "document-frequencies"), n_docs


def fit_idf(tf: DataFrame | TermBlocks, n_docs) -> DataFrame | BlockIdf:
    """(term, df, idf) from term counts; ``n_docs`` is a column or number (fitting corpus size)."""
    if isinstance(tf, TermBlocks):
        return BlockIdf(tf, n_docs)
    n = F.lit(n_docs) if isinstance(n_docs, (int, float)) else n_docs
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return df.withColumn("idf", F.log((1 + n) / (1 + F.col("df"))) + 1)


def frequent(idf: DataFrame) -> DataFrame:
    """The fewer than ``SHARE`` rows of ``idf`` whose terms hold more than one row in ``SHARE``."""
    rows = idf.agg(F.sum("df")).first()[0] or 0
    return idf.where(F.col("df") * SHARE > rows)


def with_idf(tf: DataFrame, idf: DataFrame, tasks: int | None = None) -> DataFrame:
    """``tf`` joined with a fitted ``idf`` on the term: frequent terms map-side, the rest by a shuffle.

    Both frames are read several times, so callers pass written tables; terms
    missing from ``idf`` are dropped.  ``tasks``: the parts of the shuffle, so that each
    is sorted in memory.
    """
    top = frequent(idf)
    common = tf.join(F.broadcast(top), "term")
    rare = tf.join(F.broadcast(top.select("term")), "term", "left_anti")
    if tasks:
        rare, idf = rare.repartition(tasks, "term"), idf.repartition(tasks, "term")
    return common.unionByName(rare.join(idf, "term"))


def _block_weights(blocks: TermBlocks, idf: BlockIdf) -> DataFrame:
    parts, n_docs = blocks.parts, idf.n_docs

    def work(block: int, rows: pa.Table, got: pa.Table) -> pa.Table:
        own = Counted(rows)
        df, _ = frequencies(own, parts, got)
        raw = own.tf * smooth_idf(df, n_docs)[own.term]
        norm = np.sqrt(np.bincount(own.doc, raw * raw, len(own.ids)))
        terms = own.lines(np.arange(own.n))
        return in_batches(pa.table({"doc_id": own.ids.take(pa.array(own.doc)), "term": terms.take(pa.array(own.term)), "tf": own.tf, "df": df[own.term], "norm": norm[own.doc]}))

    kind = blocks.rows.schema["id"].dataType.simpleString()
    known = blocks.run(work, f"doc_id {kind}, term string, tf long, df long, norm double", idf.replies)
    known = known.withColumn("idf", F.log((1 + F.lit(n_docs)) / (1 + F.col("df"))) + 1)
    return known.select("doc_id", "term", "tf", "df", "idf", (F.col("tf") * F.col("idf") / F.col("norm")).alias("weight"))


def tfidf(tf: DataFrame | TermBlocks, idf: DataFrame | BlockIdf, tasks: int | None = None) -> DataFrame:
    """(doc_id, term, tf, df, idf, weight) of ``tf`` rows with a fitted ``idf``."""
    if isinstance(tf, TermBlocks):
        return _block_weights(tf, idf)
    own = Window.partitionBy("doc_id")
    joined = with_idf(tf, idf, tasks)
    # back by id before anything is worked out: products are not shuffled, and a part's rows are sorted in memory
    joined = joined.repartition(tasks, "doc_id") if tasks else joined
    raw = joined.withColumn("raw", F.col("tf") * F.col("idf"))
    return raw.withColumn("weight", F.col("raw") / F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(own))).drop("raw")
