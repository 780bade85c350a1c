"""Same-store cohort (C1) and daily segment values (C7) on the FIXTURES.md §D store cases."""

from decimal import Decimal as D

from pyspark.sql import functions as F

from tillwise.operators.cohort import daily_values_by_segment, same_store_panel, store_day_values

def as_of():
    return F.to_date(F.lit("2024-03-15"))


def _frames(spark):
    tx = spark.createDataFrame([
        (1, 202401, "20240105", "Compra Pix", D("10.00")), (1, 202402, "20240205", "Compra Cartao", D("1.00")),
        (2, 202401, "20240105", "Compra Cartao", D("5.00")),                    # misses February
        (3, 202402, "20240205", "Compra Pix", D("7.00")),                       # SMART, one month
        (5, 202401, "20240105", "Compra Cartao", D("2.00")), (5, 202402, "20240206", "Compra Pix", D("3.00")),
        (6, 202403, "20240301", "Compra Cartao", D("9.00")),                    # current month only
        (1, 202403, "20240301", "Compra Pix", D("4.00")),                       # current month still summed
    ], "store long, anomes int, data_trn string, tipo string, valor decimal(18,2)")
    clients = spark.createDataFrame([
        (1, "VAREJO ALIMENTAR"), (2, "VAREJO ALIMENTAR"), (3, "SMART"), (4, "SMART"),
        (5, "VAREJO ALIMENTAR"), (5, "SMART"), (6, "VAREJO ALIMENTAR"), (7, "OUTRO"),
    ], "codcliend long, segment string")
    return tx, clients


def test_cohort_cases(spark):
    tx, clients = _frames(spark)
    days = store_day_values(tx, persist=False)
    got = sorted(((r.codcli if r.codcli is not None else -1), r.segment)
                 for r in same_store_panel(clients, days, as_of()).collect())
    # 4 is SMART with no history -> NULL codcli (as the left join gives); 5 is in both segments
    assert got == [(-1, "SMART"), (1, "VAREJO ALIMENTAR"), (3, "SMART"), (5, "SMART"), (5, "VAREJO ALIMENTAR")]


def test_daily_values_count_store_in_two_segments(spark):
    tx, clients = _frames(spark)
    days = store_day_values(tx, persist=False)
    vals = {r.data_trn: r for r in daily_values_by_segment(days, same_store_panel(clients, days, as_of())).collect()}
    assert vals["20240105"].VALOR_TOTAL == 12.0 and vals["20240105"].VLR_TOTAL_PIX == 10.0
    assert vals["20240206"].VALOR_TOTAL == 3.0 and vals["20240206"].VALOR_SMART_TOTAL == 3.0
    assert vals["20240205"].VALOR_SMART_TOTAL == 7.0 and vals["20240205"].VLR_SMART_PIX == 7.0
    assert vals["20240301"].VALOR_TOTAL == 4.0   # store 6 (current month only) is not in the cohort
    assert "20240105" in vals and vals["20240105"].VALOR_SMART_TOTAL == 2.0


def test_overwrite_table(spark, tmp_path):
    from tillwise.sources.sinks import overwrite_table
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tw_test LOCATION '{tmp_path}'")
    overwrite_table(spark.createDataFrame([(1,)], "x int"), "tw_test.t")
    overwrite_table(spark.createDataFrame([(2,), (3,)], "x int"), "tw_test.t")
    assert sorted(r.x for r in spark.table("tw_test.t").collect()) == [2, 3]


def test_read_holiday_table(spark, tmp_path):
    import datetime as dt

    from tillwise.sources.tables import read_holiday_table
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tw_hol LOCATION '{tmp_path}'")
    spark.createDataFrame([(dt.date(2024, 1, 1), "Confraternizacao Universal")], "DATA date, holiday string") \
        .write.mode("overwrite").saveAsTable("tw_hol.feriados")
    assert [tuple(r) for r in read_holiday_table(spark, "tw_hol.feriados").collect()] == \
        [(dt.date(2024, 1, 1), "Confraternizacao Universal")]


def test_build_abt_from_catalog_tables(spark, tmp_path):
    """The switch path: original-named catalog tables -> build_abt, same result as the fixture run."""
    from tests.conftest import SF001
    from tillwise.functions.calendar import calendar_between, holidays_for_years, literal_bounds, years_between
    from tillwise.plans.abt import abt_daily, build_abt
    from tillwise.sources import fixtures
    from tillwise.sources.tables import (Tables, read_calendar_table, read_client_table, read_holiday_table,
                                         read_transactions_table)
    t = Tables(spark, SF001)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tw_src LOCATION '{tmp_path}/src'")
    fixtures.transactions(t).selectExpr("store AS CODLOJASITEF", "anomes AS NUMANOMES", "data_trn AS DATA_TRN",
                                        "tipo AS TIPO_TRANSACAO", "valor AS VALOR") \
        .write.mode("overwrite").saveAsTable("tw_src.resumo")
    fixtures.client_dim(t).selectExpr("codcliend", "segment AS DESUNDNGCCLI").write.mode("overwrite").saveAsTable("tw_src.cli")
    bounds = literal_bounds(spark, "1995-01-01", "2001-12-31")
    calendar_between(bounds).selectExpr(
        "data AS Data", "dia AS Dia", "ano_mes AS numero_do_ano_mes", "semana_ano AS Semanas_do_Ano",
        "dow AS numero_do_dia_da_semana", "primeiro_dia AS flag_primeiro_dia_do_mes",
        "ultimo_dia AS flag_ultimo_dia_do_mes", "semana_mes AS numero_da_semana_no_mes") \
        .write.mode("overwrite").saveAsTable("tw_src.dim_pod")
    holidays_for_years(years_between(bounds)).selectExpr("data AS DATA", "holiday") \
        .write.mode("overwrite").saveAsTable("tw_src.feriados")
    got = build_abt(read_transactions_table(spark, "tw_src.resumo"), read_client_table(spark, "tw_src.cli"),
                    read_calendar_table(spark, "tw_src.dim_pod"), read_holiday_table(spark, "tw_src.feriados"),
                    as_of="2001-12-15")
    exp = abt_daily(spark, SF001, as_of="2001-12-15")
    assert got.columns == exp.columns
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
