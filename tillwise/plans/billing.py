"""Billing cost jobs: priced usage (J1, P1-P5), daily sums (A6), roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.columns import SKU_FAMILY_DEFAULT, SKU_FAMILY_RULES, bucket_by_substring
from tillwise.operators.range_join import containment_join
from tillwise.sources import fixtures
from tillwise.sources.tables import Tables

ALL = "ALL"


def price_usage(usage: DataFrame, prices: DataFrame, unit: str = "DBU") -> DataFrame:
    """Row-level priced usage with the SKU family and the original SKU name.

    ``custo_dec`` keeps the exact decimal product for downstream sums; ``custo``
    is its double, as the reference reports it.
    """
    u = usage.where(F.col("usage_unit") == unit).select(
        "cloud", "sku_name", "workspace_id", "usage_date", "usage_quantity",
        "usage_start_time", "usage_end_time")
    p = prices.select("cloud", "sku_name", "price_start_time", "price_end_time",
                      F.col("pricing.default").alias("price"))
    j = containment_join(u, p, ["cloud", "sku_name"], "usage_start_time", "usage_end_time",
                         "price_start_time", "price_end_time")
    cost = (F.col("price") * F.col("usage_quantity"))
    return j.select(
        "workspace_id",
        F.col("usage_date").alias("ds"),
        bucket_by_substring(F.col("sku_name"), SKU_FAMILY_RULES, SKU_FAMILY_DEFAULT).alias("sku"),
        F.col("usage_quantity").cast("double").alias("dbus"),
        cost.cast("double").alias("custo"),
        F.col("sku_name").alias("original_sku"),
        F.col("usage_quantity").alias("dbus_dec"),
        cost.alias("custo_dec"),
    )


def daily_by_sku(priced: DataFrame) -> DataFrame:
    """(ds, sku, workspace_id) -> total dbus and cost (exact decimal sums)."""
    return priced.groupBy("ds", "sku", "workspace_id").agg(
        F.sum("dbus_dec").cast("double").alias("dbus"),
        F.sum("custo_dec").cast("double").alias("custo"))


def daily_with_rollup(priced: DataFrame) -> DataFrame:
    """A6 + A7 in one aggregation: grouping sets (ds, sku, ws) and (ds) -> sku = ws = 'ALL'."""
    g = priced.groupingSets([["ds", "sku", "workspace_id"], ["ds"]], "ds", "sku", "workspace_id").agg(
        F.sum("dbus_dec").cast("double").alias("dbus"),
        F.sum("custo_dec").cast("double").alias("custo"),
        F.grouping_id().alias("_gid"))
    rolled = F.col("_gid") > 0
    return g.select(
        "ds",
        F.when(rolled, F.lit(ALL)).otherwise(F.col("sku")).alias("sku"),
        F.when(rolled, F.lit(ALL)).otherwise(F.col("workspace_id")).alias("workspace_id"),
        "dbus", "custo")


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return price_usage(fixtures.usage(t), fixtures.list_prices(t))


def priced_usage_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _priced(spark, sf_dir).drop("dbus_dec", "custo_dec")


def sku_family_daily_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_by_sku(_priced(spark, sf_dir))


def daily_rollup_all_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_with_rollup(_priced(spark, sf_dir))


def global_cost_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 'ALL' daily series (ds, y = cost, dbus) the cost forecast is trained on."""
    return (daily_with_rollup(_priced(spark, sf_dir)).where(F.col("sku") == ALL)
            .select("ds", F.col("custo").alias("y"), "dbus", "sku", "workspace_id"))


def write_billing_tables(spark: SparkSession, sf_dir: str | None, database: str,
                         usage: DataFrame | None = None, prices: DataFrame | None = None) -> None:
    """Billing job sinks (S9): row-level priced usage and the daily sums, each in its own
    table named for what it holds (the original stored the row-level frame under a 'daily' name).

    ``usage`` / ``prices`` take the billing system tables as they are (same column
    names); without them the test-data stand-ins under ``sf_dir`` are used."""
    from tillwise.sources.sinks import overwrite_table

    priced = _priced(spark, sf_dir) if usage is None else price_usage(usage, prices)
    overwrite_table(priced.drop("dbus_dec", "custo_dec"), f"{database}.priced_usage")
    overwrite_table(daily_with_rollup(priced), f"{database}.daily_cost")
