"""Range join to SCD2 prices (J1), SKU families (P4), roll-up."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillwise.functions.columns import SKU_FAMILY_DEFAULT, SKU_FAMILY_RULES, bucket_by_substring, clip_below_zero
from tillwise.operators.range_join import containment_join

T = dt.datetime


@pytest.fixture
def frames(spark):
    usage = spark.createDataFrame([
        (1, "AWS", "A", T(2024, 1, 3, 10), T(2024, 1, 3, 11)),    # inside first price
        (2, "AWS", "A", T(2024, 1, 7, 23, 30), T(2024, 1, 8, 0, 30)),  # straddles the change -> dropped
        (3, "AWS", "A", T(2024, 3, 1), T(2024, 3, 1, 1)),         # open-ended price
        (4, "AWS", "B", T(2024, 1, 3), T(2024, 1, 3, 1)),         # two overlapping prices -> twice
        (5, "AWS", "C", T(2024, 1, 3), T(2024, 1, 3, 1)),         # no price -> dropped
    ], "id int, cloud string, sku_name string, s timestamp, e timestamp")
    prices = spark.createDataFrame([
        ("AWS", "A", T(2024, 1, 1), T(2024, 1, 8), 1.0),
        ("AWS", "A", T(2024, 1, 8), None, 2.0),
        ("AWS", "B", T(2024, 1, 1), T(2024, 2, 1), 3.0),
        ("AWS", "B", T(2024, 1, 2), None, 4.0),
    ], "cloud string, sku_name string, ps timestamp, pe timestamp, price double")
    return usage, prices


def test_containment_join(frames):
    usage, prices = frames
    j = containment_join(usage, prices, ["cloud", "sku_name"], "s", "e", "ps", "pe")
    got = sorted((r.id, r.price) for r in j.select("id", "price").collect())
    assert got == [(1, 1.0), (3, 2.0), (4, 3.0), (4, 4.0)]


def test_future_reversed_and_long_intervals(spark, frames):
    usage, _ = frames
    prices = spark.createDataFrame([
        ("AWS", "A", T(2031, 1, 1), None, 1.0),                   # open price from the future on
        ("AWS", "A", T(2024, 2, 1), T(2024, 1, 1), 2.0),          # ends before it starts
        ("AWS", "A", T(2001, 1, 1), T(2040, 1, 1), 3.0),          # over many years
        ("AWS", "A", T(1999, 1, 1), T(1999, 2, 1), 4.0),          # long gone
    ], "cloud string, sku_name string, ps timestamp, pe timestamp, price double")
    j = containment_join(usage, prices, ["cloud", "sku_name"], "s", "e", "ps", "pe")
    assert {r.price for r in j.collect()} == {3.0}
    assert j.count() == usage.where("sku_name = 'A' and cloud = 'AWS'").count()


def test_hot_sku(spark):
    usage = spark.range(3000).selectExpr("id", "'AWS' AS cloud", "'A' AS sku_name", "timestamp'2024-01-01' + make_interval(0, 0, 0, int(id % 700)) AS s").selectExpr("*", "s + interval 1 hour AS e")
    prices = spark.range(24).selectExpr("'AWS' AS cloud", "'A' AS sku_name", "add_months(date'2024-01-01', int(id))::timestamp AS ps", "add_months(date'2024-01-01', int(id) + 1)::timestamp AS pe", "double(id) AS price")
    j = containment_join(usage, prices, ["cloud", "sku_name"], "s", "e", "ps", "pe")
    assert j.count() == 3000 and j.where("price <> months_between(trunc(s, 'MM'), date'2024-01-01')").count() == 0


def test_sku_family(spark):
    df = spark.createDataFrame([("PREMIUM_JOBS_SQL",), (None,), ("premium_jobs",), ("X_INFERENCE",),
                                ("STANDARD_ALL_PURPOSE",)], "s string")
    got = [r.f for r in df.select(bucket_by_substring(F.col("s"), SKU_FAMILY_RULES, SKU_FAMILY_DEFAULT)
                                  .alias("f")).collect()]
    assert got == ["JOBS", "OTHER", "OTHER", "MODEL_INFERENCE", "ALL_PURPOSE"]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-1.5,), (None,), (2.0,)], "x double")
    assert [r.c for r in df.select(clip_below_zero(F.col("x")).alias("c")).collect()] == [0.0, None, 2.0]


def test_rollup_has_all_rows(spark):
    from tillwise.plans.billing import daily_with_rollup
    priced = spark.createDataFrame([
        (dt.date(2024, 1, 1), "JOBS", "w1", D("1"), D("2")), (dt.date(2024, 1, 1), "SQL", "w2", D("3"), D("4")),
    ], "ds date, sku string, workspace_id string, dbus_dec decimal(18,2), custo_dec decimal(18,4)")
    got = {(r.sku, r.workspace_id): r.custo for r in daily_with_rollup(priced).collect()}
    assert got == {("JOBS", "w1"): 2.0, ("SQL", "w2"): 4.0, ("ALL", "ALL"): 6.0}
