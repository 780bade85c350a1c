"""Multinomial naive Bayes in long form (M13-M16, A16, A17), for any number of labels.

Training is two sums: (term, label) -> occurrences and label -> documents.
Scoring joins a document's terms with the labels that share them; a term that all
labels know makes a row for each.  Nothing of the vocabulary is on the driver.
score = ln(prior) + sum tf * ln((count + 1) / (total + V)) over the n known terms of
the document, confidence the softmax over all labels, ties go to the last label in order.

A label without a term of the document scores ln(prior) - n ln(total + V), which
depends on n alone: the best such label and the sum over all of them are worked out
once for each n, from the list of all labels' sizes, so these labels join no document.

On ``TermBlocks`` both sums by term are made by an exchange between blocks of texts, and a
held-out document's sums by label where its text is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.operators.term_blocks import TOTALS, Answer, Counted, TermBlocks, classed, counts_of, in_batches, messages, spans, sums_by, without_old_shuffles
from tillwise.sources.sinks import saved


def split_md5(df: DataFrame, id_col: str, test_percent: int = 20) -> DataFrame:
    """``is_test`` for a fixed share of the ids, by the first six digits of their MD5."""
    bucket = F.conv(F.substring(F.md5(F.col(id_col).cast("string").cast("binary")), 1, 6), 16, 10).cast("long") % 100
    return df.withColumn("is_test", bucket < test_percent)


def fit(tf: DataFrame, train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(term, label, c, lead) and (label, total, prior, v) from term counts (doc_id, term, tf) and (doc_id, label)."""
    return _fit(tf.join(train, "doc_id"), train)


def _fit(own: DataFrame, train: DataFrame, tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``fit`` on counts that carry their label (doc_id, term, tf, label); with ``tasks`` the sums are written for their readers."""
    # dealt by term: a task's (term, label) sums stay in memory
    own = own.repartition(tasks, "term") if tasks else own
    counts = own.groupBy("term", "label").agg(F.sum("tf").alias("c"))
    # one label of each term stands for the term where terms are counted
    counts = counts.withColumn("lead", F.row_number().over(Window.partitionBy("term").orderBy("label")) == 1)
    if tasks:
        counts = saved(counts, "label-counts")
    kinds = counts.agg(F.count_if("lead")).scalar()
    docs = train.agg(F.count(F.lit(1))).scalar()
    labels = train.groupBy("label").agg((F.count(F.lit(1)) / docs).alias("prior"))
    totals = counts.groupBy("label").agg(F.sum("c").alias("total"))
    return counts, labels.join(totals, "label", "left").select("label", "prior", F.coalesce("total", F.lit(0)).alias("total"), kinds.alias("v"))


def predict(tf: DataFrame, test: DataFrame, counts: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, pred, conf) for every row of ``test`` (doc_id)."""
    return _predict(tf.join(test.select("doc_id"), "doc_id"), test, counts, labels)


def _predict(own: DataFrame, test: DataFrame, counts: DataFrame, labels: DataFrame, tasks: int | None = None) -> DataFrame:
    """``predict`` on the counts (doc_id, term, tf) of the rows of ``test``; with ``tasks`` the join by term has so many."""
    if tasks:
        own, counts = own.repartition(tasks, "term"), counts.repartition(tasks, "term")
    tf_of_lead = F.when(F.col("lead"), F.col("tf")).otherwise(F.lit(0))
    shared = own.join(counts, "term").groupBy("doc_id", "label").agg(F.sum(F.col("tf") * F.log(F.col("c") + 1)).alias("s"), F.sum(tf_of_lead).alias("lead"))
    shared = shared.withColumn("n", F.sum("lead").over(Window.partitionBy("doc_id"))).drop("lead")
    if tasks:
        shared = saved(shared, "label-scores")
    return _chosen(shared, test, labels)


def _chosen(shared: DataFrame, test: DataFrame, labels: DataFrame) -> DataFrame:
    """``predict`` from (doc_id, label, s, n) of the labels that share a term with a document."""
    known = shared.groupBy("doc_id").agg(F.first("n").alias("n"))
    def base(prior, total, v):
        return F.log(prior) - F.col("n") * F.log(F.greatest(total + v, F.lit(1)))

    # without known terms the labels differ by their priors alone
    sized = test.select("doc_id").join(known, "doc_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    every = labels.agg(F.collect_list(F.struct("label", "prior", "total", "v"))).scalar()
    alone = sized.select("n").distinct().withColumn("every", every).select(
        "n", F.transform("every", lambda r: F.struct(base(r["prior"], r["total"], r["v"]).alias("base"), r["label"].alias("label"))).alias("every"))
    alone = alone.withColumn("first", F.array_max("every")).select("n", F.col("first.base").alias("most"), F.col("first.label").alias("first"), "every")
    alone = alone.select("n", "most", "first", F.aggregate("every", F.lit(0.0), lambda s, x: s + F.exp(x["base"] - F.col("most"))).alias("sum"))
    own_base = base(F.col("prior"), F.col("total"), F.col("v"))
    scored = shared.join(labels, "label").select("doc_id", "label", own_base.alias("base"), (own_base + F.col("s")).alias("score"))
    own = scored.groupBy("doc_id").agg(F.max(F.struct("score", "label")).alias("top"), F.collect_list(F.struct("base", "score")).alias("all"))
    rows = sized.join(alone, "n").join(own, "doc_id", "left")
    rows = rows.withColumn("best", F.greatest(F.col("top"), F.struct(F.col("most").alias("score"), F.col("first").alias("label"))))
    high, none = F.col("best.score"), F.array().cast("array<struct<base:double,score:double>>")
    # labels that share a term count with their full score in place of the base
    mine = F.aggregate(F.coalesce("all", none), F.lit(0.0), lambda s, x: s + F.exp(x["score"] - high))
    known_base = F.aggregate(F.coalesce("all", none), F.lit(0.0), lambda s, x: s + F.exp(x["base"] - F.col("most")))
    rest = F.greatest(F.col("sum") - known_base, F.lit(0.0)) * F.exp(F.col("most") - high)
    return rows.select("doc_id", F.col("best.label").alias("pred"), (1 / F.greatest(mine + rest, F.lit(1.0))).alias("conf"))


class BlockCounts:
    """Texts of (id, text, label) in blocks, what they were sent (label sums of the terms of held-out texts), and all labels."""

    def __init__(self, tf: TermBlocks, train: DataFrame, test_percent: int):
        spark = train.sparkSession
        names = [r[0] for r in train.select("label").distinct().orderBy("label").collect()]
        #: Labels in order; their place is the number by which blocks know them.
        self.index = spark.createDataFrame(list(enumerate(names)), T.StructType([T.StructField("y", T.IntegerType()), train.schema["label"]]))
        rows = split_md5(tf.rows.where("id is not null"), "id", test_percent).join(F.broadcast(self.index), "label", "left")
        self.blocks = tf.on(rows.select("id", "text", "y", (~F.col("is_test") & F.col("label").isNotNull()).alias("learns"), (F.col("is_test") & F.col("label").isNotNull()).alias("tests")))
        parts, wide = self.blocks.parts, max(len(names), 1)

        def sums(block: int, rows: pa.Table) -> pa.Table:
            own = Counted(rows)
            doc, y, n = classed(own, rows, "learns")
            held = np.bincount(doc, minlength=len(own.ids))
            begin = (np.cumsum(held) - held)[own.doc]
            held = held[own.doc]
            pick = spans(begin, held)
            key, c = sums_by(np.repeat(own.term, held) * wide + y[pick], np.repeat(own.tf, held) * n[pick])
            asked = np.zeros(own.n, bool)
            asked[own.term[counts_of(own, rows, "tests")[own.doc] > 0]] = True
            return messages(block, own, parts, key // wide, key % wide, c, asked)

        self.replies = self.blocks.exchange(sums, "label-counts", totals=True)
        totals = self.replies.where(F.col("block") == TOTALS).groupBy(F.col("column").alias("y")).agg(F.sum("total").alias("total"))
        kinds = totals.where("y = -1").agg(F.sum("total")).first()[0] or 0
        sizes = train.groupBy("label").agg((F.count(F.lit(1)) / F.lit(train.count())).alias("prior")).join(F.broadcast(self.index), "label")
        self.labels = saved(sizes.join(totals, "y", "left").select("label", "prior", F.coalesce("total", F.lit(0)).alias("total"), F.lit(kinds).cast("long").alias("v")), "labels")

    def shared(self) -> DataFrame:
        """(doc_id, label, s, n) of the held-out documents, as ``_predict`` has them."""
        parts, wide = self.blocks.parts, max(self.index.count(), 1)

        def score(block: int, rows: pa.Table, got: pa.Table) -> pa.Table:
            own = Counted(rows)
            times = counts_of(own, rows, "tests")
            some = times[own.doc] > 0
            term, doc, tf = own.term[some], own.doc[some], (own.tf * times[own.doc])[some]
            asked = np.zeros(own.n, bool)
            asked[term] = True
            answer = Answer(own, parts, asked, got, np.int64)
            place, y, c = answer.pairs(term)
            key, s = sums_by(doc[place] * wide + y, tf[place] * np.log(c + 1.0))
            known = answer.held[term] > 0
            n = np.bincount(doc[known], tf[known], len(own.ids)).astype(np.int64)
            return in_batches(pa.table({"doc_id": own.ids.take(pa.array(key // wide)), "y": (key % wide).astype(np.int32), "s": s, "n": n[key // wide]}))

        kind = self.blocks.rows.schema["id"].dataType.simpleString()
        with without_old_shuffles(self.index.sparkSession):
            out = saved(self.blocks.run(score, f"doc_id {kind}, y int, s double, n long", self.replies), "label-scores")
        return out.join(F.broadcast(self.index), "y").select("doc_id", "label", "s", "n")


def classify(docs: DataFrame, tf: DataFrame | TermBlocks, id_col: str, label_col: str, test_percent: int = 20, tasks: int | None = None) -> DataFrame:
    """(doc_id, label, pred, conf, correct) of the held-out documents.

    ``tasks``: the parts into which ``tf`` was dealt by ``doc_id`` (``term_counts``); it is then read once.
    ``TermBlocks`` carry the label with the texts (id, text, label).
    """
    marked = split_md5(docs.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")), "doc_id", test_percent)
    train, test = marked.where("not is_test").select("doc_id", "label"), marked.where("is_test").select("doc_id", "label")
    if isinstance(tf, TermBlocks):
        own = BlockCounts(tf, train, test_percent)
        got = _chosen(own.shared(), test, own.labels)
    elif tasks:
        # counts meet their label where they were counted, and are written once for training and scoring
        own = saved(tf.join(marked.repartition(tasks, "doc_id").hint("shuffle_hash"), "doc_id"), "label-terms", "is_test")
        got = _predict(own.where("is_test").drop("label"), test, *_fit(own.where("not is_test"), train, tasks), tasks)
    else:
        got = predict(tf, test, *fit(tf, train))
    return test.join(got, "doc_id").select("doc_id", "label", "pred", F.round("conf", 6).alias("conf"), (F.col("label") == F.col("pred")).cast("int").alias("correct"))
