"""Same-store cohort (C1: A1, A2, J2, J3, A3) and daily values by segment.

The fact table is scanned once and pre-aggregated to (store, day, is_pix)
partial sums (``store_day_values``); the month counts, the cohort and the
daily segment sums are all derived from that, so a 100 TB transaction table
is reduced map-side before any shuffle, and a store holding a third of all
rows becomes at most two rows per day after the partial aggregate.
Decimal sums are exact, so the pre-aggregation does not change results.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.sources.fixtures import PIX, SMART, VAREJO


def month_start_key(as_of: Column) -> Column:
    """'yyyyMM01' of ``as_of``: a yyyyMMdd string below it is in a past month."""
    return F.date_format(F.trunc(as_of, "MM"), "yyyyMMdd")


def store_day_values(transactions: DataFrame, persist: bool = True) -> DataFrame:
    """(store, data_trn, anomes, is_pix) -> exact decimal sum of valor.

    Persisted (memory + disk) by default: the month counts, the cohort and the
    daily sums all read it, and without it Catalyst pushes the past-months
    filter below the aggregate and scans the fact once per branch.  The
    persisted table is stores x days x 2 rows - orders of magnitude smaller
    than the fact - and lost blocks are recomputed from lineage.
    """
    days = (transactions
            .groupBy("store", "data_trn", "anomes", (F.col("tipo") == PIX).alias("is_pix"))
            .agg(F.sum("valor").alias("valor")))
    return days.persist(StorageLevel.MEMORY_AND_DISK) if persist else days


def store_months(store_days: DataFrame, as_of: Column) -> DataFrame:
    """A1: distinct past months per store (days before the month of ``as_of``)."""
    past = store_days.where(F.col("data_trn") < month_start_key(as_of))
    return past.groupBy("store").agg(F.countDistinct("anomes").alias("qtd_meses"))


def total_months(store_days: DataFrame, as_of: Column) -> Column:
    """A2: distinct past months over all stores, as a scalar subquery column."""
    past = store_days.where(F.col("data_trn") < month_start_key(as_of))
    return past.agg(F.countDistinct("anomes")).scalar()


def same_store_panel(client_dim: DataFrame, store_days: DataFrame, as_of: Column,
                     segments: tuple[str, ...] = (VAREJO, SMART), exempt: str = SMART) -> DataFrame:
    """(codcli, segment) of stores present in every past month; ``exempt`` segment always kept.

    The theta condition ``months = total OR segment = exempt`` is a filter
    against a scalar subquery (one value), not a nested-loop join.  A client
    of the exempt segment without past transactions yields codcli NULL, as a
    left join does; NULL matches no fact row later.
    """
    months = store_months(store_days, as_of)
    total = total_months(store_days, as_of)
    clients = client_dim.where(F.col("segment").isin(*segments))
    return (clients.join(months, F.col("codcliend") == F.col("store"), "left")
            .where((F.col("qtd_meses") == total) | (F.col("segment") == exempt))
            .select(F.col("store").alias("codcli"), "segment")
            .distinct())


def daily_values_by_segment(store_days: DataFrame, cohort: DataFrame) -> DataFrame:
    """Per day, rounded sums of value by segment and Pix type (cohort stores only)."""
    joined = store_days.join(cohort, F.col("store") == F.col("codcli"))
    seg, pix, v = F.col("segment"), F.col("is_pix"), F.col("valor")

    def rsum(cond: Column, name: str) -> Column:
        return F.round(F.sum(F.when(cond, v).otherwise(F.lit(0))), 2).cast("double").alias(name)

    return joined.groupBy("data_trn").agg(
        rsum((seg == SMART) & pix, "VLR_SMART_PIX"),
        rsum((seg == VAREJO) & pix, "VLR_TOTAL_PIX"),
        rsum(seg == VAREJO, "VALOR_TOTAL"),
        rsum(seg == SMART, "VALOR_SMART_TOTAL"),
    )
