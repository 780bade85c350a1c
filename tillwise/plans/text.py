"""Text feature jobs: cleaning, n-gram counts, TF-IDF, label index, threshold sweep."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.functions.text import clean_special, terms
from tillwise.operators.term_blocks import TermBlocks
from tillwise.operators.tfidf import fit_idf, term_counts, text_tasks, tfidf
from tillwise.operators.threshold import best_threshold, threshold_sweep
from tillwise.sources import fixtures
from tillwise.session import per_application
from tillwise.sources.tables import Tables, ensure_parallelism


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents spread over the cluster's cores before per-row text work."""
    return ensure_parallelism(Tables(spark, sf_dir).documents)


def _term_counts(docs: DataFrame, tasks: int | None = None) -> DataFrame:
    """(doc_id, term, tf) of ``docs``, dealt by id."""
    return term_counts(docs, "doc_id", terms(F.col("text")), tasks or text_tasks(docs))


def clean_text_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return docs.select("doc_id", clean_special(F.col("text")).alias("clean"))


def token_ngrams_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _term_counts(Tables(spark, sf_dir).documents)


def tfidf_long_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).documents
    tf = TermBlocks(docs.select(F.col("doc_id").alias("id"), "text"))
    w = tfidf(tf, fit_idf(tf, docs.count()))
    return w.select("doc_id", "term", "tf", "df", F.round("idf", 9).alias("idf"),
                    F.round("weight", 9).alias("weight"))


def label_index(df: DataFrame, label_col: str, out_col: str = "label_idx"):
    """One alphabetical label index, fitted once and reused for every split."""
    return StringIndexer(inputCol=label_col, outputCol=out_col, stringOrderType="alphabetAsc",
                         handleInvalid="keep").fit(df)


def label_index_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = Tables(spark, sf_dir).part.select("p_partkey", "p_type")
    model = label_index(part, "p_type")
    return model.transform(part)


def threshold_sweep_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_sweep(fixtures.scored_labels(Tables(spark, sf_dir)))


def best_threshold_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_threshold(threshold_sweep(fixtures.scored_labels(Tables(spark, sf_dir))))


def _classifier_scores(spark: SparkSession, sf_dir: str, kind: str = "svm") -> DataFrame:
    """Held-out scores of the classifier trained on the other 80 %; trained once per application."""
    from tillwise.operators import text_model as TM

    def build():
        return TM.classify_texts(_documents(spark, sf_dir), "doc_id", "text", "lang", kind=kind).persist()

    return per_application(spark, ("text_classifier", sf_dir, kind), build)


def text_classifier_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out documents with predicted language, calibrated confidence, correct flag."""
    return _classifier_scores(spark, sf_dir)


def linear_scores_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M13's scoring step with given weights: margins of the held-out texts under the mean vector of each class."""
    from tillwise.operators import linear_margins as LM
    from tillwise.operators.naive_bayes import split_md5

    docs = split_md5(Tables(spark, sf_dir).documents.where("lang is not null"), "doc_id").where("is_test is not null")
    rows = docs.select(F.col("doc_id").alias("row"), F.col("lang").alias("cls"), "is_test")
    train = rows.where("not is_test")
    of_row = train.groupBy("row", "cls").agg(F.count("*").alias("n")).withColumn("rows", F.sum("n").over(Window.partitionBy("row")))
    sizes = of_row.groupBy("cls").agg(F.sum(F.col("n") * F.col("rows")).alias("n")).orderBy("cls").collect()
    index = spark.createDataFrame([(y, r["cls"]) for y, r in enumerate(sizes)], "y int, cls string")
    if not sizes:  # nothing to learn from: no class has a margin
        return rows.where("false").select(F.col("row").alias("doc_id"), "cls", F.lit(0.0).alias("margin"))
    texts = docs.join(F.broadcast(index), F.col("lang") == F.col("cls"), "left")
    tf = TermBlocks(texts.select(F.col("doc_id").alias("id"), "text", "y", (~F.col("is_test")).alias("learns"), F.col("is_test").alias("tests")))
    x = LM.BlockVectors(tf, LM.Vocabulary(tf, train.count()), [r["n"] for r in sizes])
    margins = LM.score(x, x.class_sums()).join(F.broadcast(index), "y")
    return margins.select(F.col("row").alias("doc_id"), "cls", F.round("margin", 9).alias("margin"))


def platt_step_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M14's Newton step: Platt parameters after one step on the scored labels, in three classes at once."""
    from tillwise.operators import linear_margins as LM
    from tillwise.operators.metrics import significant

    scored = fixtures.scored_labels(Tables(spark, sf_dir))
    margins = scored.select(F.pmod("doc_id", F.lit(3)).cast("int").alias("cls"), (F.col("conf") * 4 - 2).alias("margin"), F.col("truth").cast("double").alias("target"))
    done = LM.platt_step(margins, LM.platt_start(margins))
    return done.select("cls", *(significant(F.col(c)).alias(c) for c in ("a", "b", "step")))


def classifier_threshold_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13 on the classifier's own output: truth = correct flag, score = confidence."""
    return threshold_sweep(_classifier_scores(spark, sf_dir), conf="conf", truth="correct")


def text_classifier_gbt_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same held-out scoring with one-vs-rest boosted trees (100 trees, depth 3)."""
    return _classifier_scores(spark, sf_dir, kind="gbt")


def _bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillwise.operators.naive_bayes import classify

    docs = Tables(spark, sf_dir).documents
    tf = TermBlocks(docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("label")))
    return classify(docs.select("doc_id", "lang"), tf, "doc_id", "lang")


def bayes_classifier_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M13-M16 by naive Bayes: held-out documents with predicted language, confidence, correct flag."""
    return _bayes(spark, sf_dir)


def classifier_accuracy_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, and the share predicted right, for each language."""
    return _bayes(spark, sf_dir).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.avg("correct").alias("accuracy"))


def run_text_classifier_job(spark: SparkSession, sf_dir: str, out_path: str, kind: str = "svm") -> DataFrame:
    """Classifier as a job: held-out scores written as CSV (S11); returns the best
    confidence threshold of its own output (A13, A14)."""
    from tillwise.sources.sinks import write_csv

    scored = _classifier_scores(spark, sf_dir, kind)
    write_csv(scored, out_path)
    return best_threshold(threshold_sweep(scored, conf="conf", truth="correct"))
