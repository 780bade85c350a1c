"""A training-corpus pipeline from the operators in ``tillwise.llm``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns the documents it keeps, with their columns (the last: their token ids).
``run`` writes each stage's rows as Parquet under ``spark.checkpoint.dir`` and
reads them as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import byte_bpe, decontaminate, pii, quality_rules, simhash_gray
from tillwise.llm.common import Scratch, fresh, table
from tillwise.llm.queries import PATTERN, VOCABULARY
from tillwise.session import apply_job_conf


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the certified cutoffs reject."""
    judged = fresh(docs, "judged")
    kept = quality_rules.judge(docs, table(spark, sf_dir, "labels"), judged)
    return kept.where(F.col(judged)["kept"]).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document (smallest id) of each SimHash component."""
    return simhash_gray.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.Decontaminator(docs, table(spark, sf_dir, "benchmark")).clean(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; ``n_chars`` follows the text."""
    clean = pii.Extractor(docs).redacted(docs.columns)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the other columns in place of the text."""
    keep = [c for c in docs.columns if c != "text"]
    ids = fresh(docs, "token_ids")
    encoded = byte_bpe.encode(docs, VOCABULARY, PATTERN, ids=ids, keep=keep)
    return encoded.withColumn(fresh(encoded, "n_tokens"), F.size(ids).cast("long"))


def staged(function):
    """``function`` on a session with the settings that all jobs rely on."""
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return function(apply_job_conf(spark), docs, sf_dir)

    stage.__doc__ = function.__doc__
    return stage


STAGES = [
    ("quality_rules", staged(quality)),
    ("simhash_near_dedup", staged(near_duplicates)),
    ("benchmark_decontamination", staged(decontamination)),
    ("pii", staged(personal_data)),
    ("byte_bpe", staged(tokens)),
]

#: Near duplicates, merges and cutoffs have no SQL form; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    last = None
    for _, stage in STAGES:
        done = scratch.save(stage(spark, docs, sf_dir))
        if last is not None:
            scratch.drop(last)
        docs = last = done
    return docs
