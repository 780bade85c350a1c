"""Flyer feed jobs over all customers (F1-F8)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.operators import flyer as FL
from tillwise.sources import fixtures
from tillwise.sources.tables import Tables

PAGE_SIZE = 50


def _paged(t: Tables) -> DataFrame:
    """Best sellers with party and page, kept (memory + disk) for the several branches
    that read them - requests, responses, resolution, feed - so orders x lineitem is
    joined once; lost blocks are recomputed from lineage."""
    best = fixtures.best_sellers(t).persist(StorageLevel.MEMORY_AND_DISK)
    paged = FL.assign_pages(best.select("*", *FL.party_columns(F.col("codmersrr"))), PAGE_SIZE)
    return paged.persist(StorageLevel.MEMORY_AND_DISK)


def top_sellers_q(spark: SparkSession, sf_dir: str, k: int = FL.MAX_PRODUCTS) -> DataFrame:
    """Top-k best-seller report per customer with an explicit rank."""
    best = fixtures.best_sellers(Tables(spark, sf_dir))
    w = Window.partitionBy("codcli").orderBy(F.col("qty").desc(), F.col("partkey").asc())
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def party_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 per (customer, product): party, seller, quantity and the 1P group code."""
    best = fixtures.best_sellers(Tables(spark, sf_dir))
    return best.select("codcli", "codmersrr", *FL.party_columns(F.col("codmersrr")))


def pref_ingest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FL.ingest_preferences(fixtures.preference_responses(Tables(spark, sf_dir)))


def price_request_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    prefs = FL.ingest_preferences(fixtures.preference_responses(t))
    return FL.price_requests(_paged(t), prefs)


def resolve_prices_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    paged = _paged(t)
    return FL.resolve_prices(paged, fixtures.price_responses(t, paged))


def flyer_feed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    paged = _paged(t)
    prices = FL.resolve_prices(paged, fixtures.price_responses(t, paged))
    prefs = FL.ingest_preferences(fixtures.preference_responses(t))
    slots = FL.slot_table_from_json(fixtures.slot_config(spark))
    return FL.flyer_feed(paged, fixtures.catalogue(t), prices, slots, prefs=prefs)


def wrap_caption_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 over the whole catalogue: caption 'code - description' wrapped to four lines."""
    cat = fixtures.catalogue(Tables(spark, sf_dir))
    caption = F.concat(F.element_at(F.split("idproduto", "_"), 2), F.lit(" - "), F.col("descproduto"))
    lines = FL.wrap_caption(caption)
    return cat.select("idproduto", *[lines[i].alias(f"linha_{i + 1}") for i in range(FL.CAPTION_LINES)])
