"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import byte_bpe, decontaminate, divergence, exact_dedup, html_hosts, lm_mixing, oracle, pii, prefix_trie, quality_rules, sharding, simhash_gray, suffix_columns, training_order
from tillwise.llm.common import table
from tillwise.session import apply_job_conf

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Key of the training order.
ORDER_KEY = 20_240_501


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the round trip, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = byte_bpe.encode(docs, VOCABULARY, PATTERN, decoded="decoded", keep=["doc_id"])
    return done.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("token_ids", " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15 by jump consistent hashing of doc_id."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    placed = sharding.with_slot(sharding.with_shard(docs, "doc_id", 16), "shard", ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op3_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every whole text under a model learned from nine tenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", lm_mixing.held_out(F.col("doc_id")).alias("held_out"))
    model = lm_mixing.LanguageModel(docs, ~F.col("held_out"))
    scored = model.score(docs, ["doc_id", "held_out"])
    bits = -F.col("score") * F.lit(3.321928094887362) / F.col("n_bytes")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", bits.alias("bits_per_byte"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and whether the base and the certified rules keep it."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "judged", keep=["doc_id"])
    return judged.select("doc_id", "judged.*")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a window of a benchmark item."""
    found = decontaminate.Decontaminator(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.report().select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence of 512 ids as it stands in the shards, in training order."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = training_order.materialise(docs, VOCABULARY, PATTERN, ORDER_KEY)
    return back.select("doc_id", "part", "number", "slot", "shard", "place", F.size("ids").cast("long").alias("n_ids"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text."""
    found = pii.Extractor(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    seeds, spans = F.col(found.seeds), F.col("spans")
    base = pii.each_kind(lambda k: seeds[k], lambda k, x: F.struct(F.lit(k).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return found.spans().select("doc_id", *(F.size(seeds[k]).cast("long").alias(f"n_{k}") for k in pii.KINDS), F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(spans).alias("spans"))


def op8_host_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_hosts.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash_gray.component_ids(table(spark, sf_dir, "documents"))


def op10_suffix_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the bytes of strings of 400 bytes that stand elsewhere too."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    done = suffix_columns.RepeatedStrings(docs, keep=["doc_id", "n_bytes"]).stripped()
    return done.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of equal texts of every document and whether it is the row that stays."""
    return exact_dedup.ExactDedup(table(spark, sf_dir, "documents")).classes()


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie.hundreds_trie(table(spark, sf_dir, "conversations"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of each source from the others of its language, and its most particular terms."""
    return divergence.Divergence(table(spark, sf_dir, "documents")).report()


def prepared(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``query`` on a session with the settings that all jobs rely on."""
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(apply_job_conf(spark), sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_jump_sharding": op2_jump_sharding,
    "op3_context_mixing": op3_context_mixing,
    "op4_quality_rules": op4_quality_rules,
    "op5_decontamination": op5_decontamination,
    "op6_training_order": op6_training_order,
    "op7_pii": op7_pii,
    "op8_host_html": op8_host_html,
    "op9_simhash": op9_simhash,
    "op10_suffix_columns": op10_suffix_columns,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_divergence": op13_divergence,
}

QUERIES = {name: prepared(query) for name, query in QUERIES.items()}

ORACLES: dict[str, str] = {
    "op11_exact_dedup": oracle.EXACT_DEDUP,
    "op12_prefix_trie": oracle.PREFIX_TRIE,
    "op13_divergence": oracle.DIVERGENCE,
}
