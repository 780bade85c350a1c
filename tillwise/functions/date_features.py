"""Date-part model features with the special-date overrides.

Day of week is Monday = 0 here, as the model features use it (the calendar
table's ``dow`` is 1 = Sunday).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwise.functions.calendar import iso_week, weekday_monday0

# Override codes of the special dates.
EVE_CODE = -10       # 24 and 31 December on DIA_SEMANA
CLOSED_CODE = 10     # 1 January and 25 December on DIA_SEMANA; 1 January on DIA_MES
OUTLIER_EVE = 1      # 24 / 31 December on OUTLIER
OUTLIER_CLOSED = -10  # 1 January / 25 December on OUTLIER
FIRST_DAY_NEW_YEAR = -10  # 1 January on PRIMEIRO_DIA


def is_eve(d: Column) -> Column:
    return (F.month(d) == 12) & F.dayofmonth(d).isin(24, 31)


def is_closed(d: Column) -> Column:
    return ((F.month(d) == 1) & (F.dayofmonth(d) == 1)) | ((F.month(d) == 12) & (F.dayofmonth(d) == 25))


def is_new_year(d: Column) -> Column:
    return (F.month(d) == 1) & (F.dayofmonth(d) == 1)


DATE_PART_NAMES = ["DIA_SEMANA", "TRIMESTRE", "MES", "ANO", "DIA_ANO", "DIA_MES", "SEMANA_ANO", "TER",
                   "QUA", "QUI", "SEX", "SAB", "DOM", "SEG", "PRIMEIRO_DIA"]


def date_part_columns(d: Column, primeiro_dia: Column, special: bool = True) -> list[Column]:
    """DIA_SEMANA ... SEG; with ``special`` the special dates' codes are laid over them."""
    wd = weekday_monday0(d)
    closed, eve, new_year = (f(d) if special else F.lit(False) for f in (is_closed, is_eve, is_new_year))
    dia_semana = (F.when(closed, F.lit(CLOSED_CODE))
                  .when(eve, F.lit(EVE_CODE)).otherwise(wd))
    dia_mes = F.when(new_year, F.lit(CLOSED_CODE)).otherwise(F.dayofmonth(d))
    dom = F.when(eve, F.lit(0)).otherwise((wd == 6).cast("int"))
    return [
        dia_semana.cast("int").alias("DIA_SEMANA"),
        F.quarter(d).alias("TRIMESTRE"),
        F.month(d).alias("MES"),
        F.year(d).alias("ANO"),
        F.dayofyear(d).alias("DIA_ANO"),
        dia_mes.cast("int").alias("DIA_MES"),
        iso_week(d).alias("SEMANA_ANO"),
        (wd == 1).cast("int").alias("TER"),
        (wd == 2).cast("int").alias("QUA"),
        (wd == 3).cast("int").alias("QUI"),
        (wd == 4).cast("int").alias("SEX"),
        (wd == 5).cast("int").alias("SAB"),
        dom.cast("int").alias("DOM"),
        (wd == 0).cast("int").alias("SEG"),
        F.when(new_year, F.lit(FIRST_DAY_NEW_YEAR)).otherwise(primeiro_dia).cast("int").alias("PRIMEIRO_DIA"),
    ]


def override_outlier(d: Column, base: Column) -> Column:
    """Outlier class with the special-date codes laid over it."""
    return (F.when(is_closed(d), F.lit(OUTLIER_CLOSED))
            .when(is_eve(d), F.lit(OUTLIER_EVE)).otherwise(base)).cast("int")
