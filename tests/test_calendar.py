"""Calendar, holiday and feature-table edge cases."""

import datetime as dt

from pyspark.sql import functions as F

from tillwise.functions.calendar import calendar_between, holidays_for_years, literal_bounds, years_between
from tillwise.functions.date_features import date_part_columns
from tillwise.operators.calendar_features import calendar_features


def _easter_reference(y):
    # independent check: the classic Gauss/Meeus algorithm written longhand
    a, b, c = y % 19, y // 100, y % 100
    d, e = b // 4, b % 4
    f = (b + 8) // 25
    g = (b - f + 1) // 3
    h = (19 * a + b - d - g + 15) % 30
    i, k = c // 4, c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = (a + 11 * h + 22 * l_) // 451
    return dt.date(y, (h + l_ - 7 * m + 114) // 31, (h + l_ - 7 * m + 114) % 31 + 1)


def test_easter_and_rules(spark):
    hol = holidays_for_years(years_between(literal_bounds(spark, "1990-01-01", "2030-12-31")))
    got = {r.data for r in hol.where(F.col("holiday") == "Pascoa").collect()}
    assert got == {_easter_reference(y) for y in range(1990, 2031)}
    h2000 = {r.holiday: r.data for r in hol.where(F.year("data") == 2000).collect()}
    assert h2000["Pascoa"] == dt.date(2000, 4, 23)
    assert h2000["Paixao de Cristo"] == dt.date(2000, 4, 21) == h2000["Tiradentes"]
    assert h2000["Dia das Maes"] == dt.date(2000, 5, 14)          # 2nd Sunday of May
    assert h2000["Black Thursday"] == dt.date(2000, 11, 23)      # 4th Thursday of November
    assert h2000["Black Friday"] == dt.date(2000, 11, 24)
    assert len(h2000) == 23


def test_one_row_per_day_with_two_holidays(spark):
    cal = calendar_between(literal_bounds(spark, "2000-01-01", "2000-12-31"))
    hol = holidays_for_years(years_between(literal_bounds(spark, "2000-01-01", "2000-12-31")))
    f = calendar_features(cal, hol).cache()
    assert f.count() == 366
    d = f.where(F.col("DATA") == dt.date(2000, 4, 21)).first()
    # Tiradentes and Good Friday on the same Friday: one row, both flags
    assert d.TIRADENTES == 1 and d.PAIXAO_CRISTO == 1 and d.FERIADO == 1 and d.SEX == 1
    thu = f.where(F.col("DATA") == dt.date(2000, 4, 20)).first()
    assert thu.VESPERA == 1 and thu.VESPERA_SEXTA == 1 and thu.Qui_Paixao == 1
    sat = f.where(F.col("DATA") == dt.date(2000, 4, 22)).first()
    assert sat.POS_SEXTA == 1
    # Easter week: Sunday-start week before Easter, inside Easter's month, plus Easter
    wk = {r.DATA for r in f.where(F.col("SEMANA_PASCOA") == 1).collect()}
    assert wk == {dt.date(2000, 4, d) for d in range(16, 24)}


def test_bridge_days(spark):
    cal = calendar_between(literal_bounds(spark, "2002-01-01", "2002-12-31"))
    hol = holidays_for_years(years_between(literal_bounds(spark, "2002-01-01", "2002-12-31")))
    f = calendar_features(cal, hol)
    # 2002-11-15 (Proclamacao) is a Friday -> eve Thursday; 2002-05-30 Corpus Christi (Thu) -> Fri bridge
    assert f.where(F.col("DATA") == dt.date(2002, 5, 31)).first().BRIDGE == 1
    # 2002-01-01 is a Tuesday -> Monday 2001-12-31 is outside the calendar; nothing breaks
    assert f.where(F.col("DATA") == dt.date(2002, 11, 14)).first().VESPERA_SEXTA == 1


def test_special_date_overrides(spark):
    days = spark.createDataFrame([(dt.date(2001, 12, 24),), (dt.date(2001, 12, 25),),
                                  (dt.date(2001, 12, 31),), (dt.date(2002, 1, 1),)], "d date")
    r = {x.d: x for x in days.select("d", *date_part_columns(F.col("d"), F.lit(0))).collect()}
    assert r[dt.date(2001, 12, 24)].DIA_SEMANA == -10 and r[dt.date(2001, 12, 24)].DOM == 0
    assert r[dt.date(2001, 12, 25)].DIA_SEMANA == 10
    assert r[dt.date(2001, 12, 31)].DIA_SEMANA == -10
    assert r[dt.date(2002, 1, 1)].DIA_SEMANA == 10 and r[dt.date(2002, 1, 1)].DIA_MES == 10
    assert r[dt.date(2002, 1, 1)].PRIMEIRO_DIA == -10
    assert r[dt.date(2001, 12, 25)].SEMANA_ANO == 52


def test_tuesday_bridge_and_easter_week_across_month(spark):
    cal = calendar_between(literal_bounds(spark, "2001-01-01", "2001-12-31"))
    hol = holidays_for_years(years_between(literal_bounds(spark, "2001-01-01", "2001-12-31")))
    f = calendar_features(cal, hol)
    # 2001-05-01 (Dia do Trabalho) is a Tuesday -> Monday 2001-04-30 is a bridge day
    assert f.where(F.col("DATA") == dt.date(2001, 4, 30)).first().BRIDGE == 1
    cal18 = calendar_between(literal_bounds(spark, "2018-01-01", "2018-12-31"))
    hol18 = holidays_for_years(years_between(literal_bounds(spark, "2018-01-01", "2018-12-31")))
    wk = {r.DATA for r in calendar_features(cal18, hol18).where(F.col("SEMANA_PASCOA") == 1).collect()}
    # Easter 2018-04-01: the week before lies in March, outside Easter's month -> only Easter itself
    assert wk == {dt.date(2018, 4, 1)}
