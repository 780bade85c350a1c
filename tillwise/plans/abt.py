"""Retail feature table (ABT, C8) and its parts as runnable jobs.

``as_of`` replaces ``current_date()`` everywhere so a run is reproducible.
"""

from __future__ import annotations

import zlib

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.calendar import (REGIONAL_HOLIDAYS, calendar_between, holidays_for_years,
                                         literal_bounds, years_between)
from tillwise.functions.columns import not_null_flag
from tillwise.operators.calendar_features import calendar_features
from tillwise.operators.cohort import daily_values_by_segment, same_store_panel, store_day_values
from tillwise.sources import fixtures
from tillwise.session import per_application
from tillwise.sources.sinks import overwrite_table, work_table
from tillwise.sources.tables import Tables, read_holiday_table

COHORT_AS_OF = "2001-12-15"
ABT_START = "1995-01-01"


def _dims(spark: SparkSession, start: str, as_of: str) -> tuple[DataFrame, DataFrame]:
    """Calendar and holidays over whole years from ``start`` to the year of ``as_of``."""
    bounds = literal_bounds(spark, start, as_of).select(
        F.trunc("start", "year").alias("start"),
        F.date_add(F.add_months(F.trunc("end", "year"), 12), -1).alias("end"))
    return calendar_between(bounds), holidays_for_years(years_between(bounds))


def calendar_feature_table(spark: SparkSession, start: str, as_of: str) -> DataFrame:
    """Calendar features for ``[start, last_day(as_of)]``; generated by rule (no data read),
    so one persisted copy per application serves every job."""
    def build() -> DataFrame:
        cal, hol = _dims(spark, start, as_of)
        end = F.last_day(F.to_date(F.lit(as_of)))
        return calendar_features(cal, hol, start=F.to_date(F.lit(start)), end=end).persist(
            StorageLevel.MEMORY_AND_DISK)
    return per_application(spark, ("calendar_features", start, as_of), build)


def data_span_dims(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Calendar and holidays over the whole years the transactions span."""
    li = t.lineitem
    bounds = li.agg(F.trunc(F.min("l_shipdate"), "year").alias("start"),
                    F.date_add(F.add_months(F.trunc(F.max("l_shipdate"), "year"), 12), -1).alias("end"))
    return calendar_between(bounds), holidays_for_years(years_between(bounds))


def build_abt(transactions: DataFrame, client_dim: DataFrame, calendar: DataFrame, holidays: DataFrame,
              as_of: str, start: str = ABT_START) -> DataFrame:
    """C8 on caller-supplied tables: calendar features for ``[start, last_day(as_of)]`` plus
    the same-store cohort's daily values, zero-filled.

    ``transactions``: store, anomes, data_trn (yyyyMMdd), tipo, valor;
    ``client_dim``: codcliend, segment; ``calendar``/``holidays`` as produced by
    ``sources.tables.read_calendar_table`` / ``read_holiday_table`` (or generated).
    ``PIX_CATEG`` is 1 when the day has any cohort transaction (the Pix sum is a
    CASE ... ELSE 0 sum, so it is NULL only when the day has no row).
    """
    as_of_c = F.to_date(F.lit(as_of))
    hol = holidays.select(F.col(holidays.columns[0]).cast("date").alias("data"), "holiday")
    feats = calendar_features(calendar, hol, start=F.to_date(F.lit(start)), end=F.last_day(as_of_c))
    return _with_values(feats, transactions, client_dim, as_of_c)


def _with_values(feats: DataFrame, transactions: DataFrame, client_dim: DataFrame, as_of_c) -> DataFrame:
    days = store_day_values(transactions)
    cohort = same_store_panel(client_dim, days, as_of_c)
    values = daily_values_by_segment(days, cohort).withColumn(
        "DATA_V", F.to_date("data_trn", "yyyyMMdd")).drop("data_trn")
    out = feats.join(values, feats["DATA"] == values["DATA_V"], "left")
    value_cols = ["VLR_SMART_PIX", "VLR_TOTAL_PIX", "VALOR_TOTAL", "VALOR_SMART_TOTAL"]
    return out.select(
        *[feats[c] for c in feats.columns],
        not_null_flag(F.col("VLR_TOTAL_PIX")).alias("PIX_CATEG"),
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in value_cols],
    ).orderBy("DATA")


def abt_daily(spark: SparkSession, sf_dir: str, as_of: str = COHORT_AS_OF,
              start: str = ABT_START, persist: bool = False) -> DataFrame:
    """C8 on the supplied test tables with a rule-generated calendar (see ``build_abt``)."""
    if persist:  # one persisted feature table per (application, input, dates), shared by the model jobs
        return per_application(spark, ("abt", sf_dir, as_of, start),
                               lambda: abt_daily(spark, sf_dir, as_of, start, persist=False)
                               .persist(StorageLevel.MEMORY_AND_DISK))
    t = Tables(spark, sf_dir)
    feats = calendar_feature_table(spark, start, as_of)
    return _with_values(feats, fixtures.transactions(t), fixtures.client_dim(t), F.to_date(F.lit(as_of)))


def same_store_panel_q(spark: SparkSession, sf_dir: str, as_of: str = COHORT_AS_OF) -> DataFrame:
    t = Tables(spark, sf_dir)
    days = store_day_values(fixtures.transactions(t))
    return same_store_panel(fixtures.client_dim(t), days, F.to_date(F.lit(as_of)))


def daily_value_by_segment_q(spark: SparkSession, sf_dir: str, as_of: str = COHORT_AS_OF) -> DataFrame:
    t = Tables(spark, sf_dir)
    days = store_day_values(fixtures.transactions(t))
    cohort = same_store_panel(fixtures.client_dim(t), days, F.to_date(F.lit(as_of)))
    return daily_values_by_segment(days, cohort)


def calendar_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2-C6 over the whole years spanned by the transactions."""
    cal, hol = data_span_dims(Tables(spark, sf_dir))
    return calendar_features(cal, hol)


def holiday_union_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regional fixed holidays + generated holidays of the data's years, duplicates kept."""
    _, hol = data_span_dims(Tables(spark, sf_dir))
    regional = spark.createDataFrame(REGIONAL_HOLIDAYS, "ds string, holiday string").select(
        F.to_date("ds").alias("ds"), "holiday")
    return regional.unionByName(hol.select(F.col("data").alias("ds"), "holiday"))


def holiday_table_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 + S2: the holidays replace a catalog table, from which they are read under its own column names."""
    name = work_table(spark, f"holidays_{zlib.crc32(sf_dir.encode()):08x}")
    overwrite_table(holiday_union_q(spark, sf_dir).withColumnRenamed("ds", "DATA"), name)
    return read_holiday_table(spark, name)


def holidays_for_span(df: DataFrame, date_col: str) -> DataFrame:
    """U1 for any dated frame: regional fixed holidays + generated holidays of the years it spans."""
    spark = df.sparkSession
    bounds = df.agg(F.min(date_col).cast("date").alias("start"), F.max(date_col).cast("date").alias("end"))
    hol = holidays_for_years(years_between(bounds))
    regional = spark.createDataFrame(REGIONAL_HOLIDAYS, "ds string, holiday string").select(
        F.to_date("ds").alias("ds"), "holiday")
    return regional.unionByName(hol.select(F.col("data").alias("ds"), "holiday"))
