"""Calendar and holiday column expressions.

The calendar dimension and the holiday table are generated here when no
such tables are supplied: one row per day built with ``sequence`` +
``explode`` from a one-row frame of bounds, so both stay on the executors and
their size is the number of days (or years x holidays) in range, never a
function of the fact data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Holiday names as they appear in the holiday table, the
# feature column each one feeds, and the date rule that places it.
# Names must match the holiday table verbatim (accent-free).  Listed in the
# order the days fall in a year.
#   ("fixed", month, day)                 a calendar date
#   ("easter", offset_days)               Easter Sunday + offset
#   ("nth_dow", month, n, dow, offset)    n-th weekday (1=Sun..7=Sat) of the
#                                         month, + offset days
# ---------------------------------------------------------------------------
HOLIDAYS: list[tuple[str, str, tuple]] = [
    ("Confraternizacao Universal", "ANO_NOVO", ("fixed", 1, 1)),
    ("Carnaval1", "CARNAVAL1", ("easter", -48)),
    ("Carnaval2", "CARNAVAL2", ("easter", -47)),
    ("Carnaval3", "CARNAVAL3", ("easter", -46)),
    ("Qui. Paixao", "Qui_Paixao", ("easter", -3)),
    ("Paixao de Cristo", "PAIXAO_CRISTO", ("easter", -2)),
    ("Sab. Pascoa", "Sab_Pascoa", ("easter", -1)),
    ("Pascoa", "PASCOA", ("easter", 0)),
    ("Tiradentes", "TIRADENTES", ("fixed", 4, 21)),
    ("Dia do Trabalho", "DIA_DO_TRABALHO", ("fixed", 5, 1)),
    ("Vespera Dia das Maes", "VESPERA_MAES", ("nth_dow", 5, 2, 1, -1)),
    ("Dia das Maes", "DIA_DAS_MAES", ("nth_dow", 5, 2, 1, 0)),
    ("Corpus Christi", "CORPUS_CHRISTI", ("easter", 60)),
    ("Dia dos Pais", "DIA_DOS_PAIS", ("nth_dow", 8, 2, 1, 0)),
    ("Independencia do Brasil", "INDEPENDENCIA", ("fixed", 9, 7)),
    ("Nossa Sr.a Aparecida - Padroeira do Brasil", "APARECIDA", ("fixed", 10, 12)),
    ("Finados", "FINADOS", ("fixed", 11, 2)),
    ("Proclamacao da Republica", "PROC_REPUBLICA", ("fixed", 11, 15)),
    ("Black Thursday", "BLACK_THURSDAY", ("nth_dow", 11, 4, 5, 0)),
    ("Black Friday", "BLACK_FRIDAY", ("nth_dow", 11, 4, 5, 1)),
    ("Vespera de Natal", "VESPERA_NATAL", ("fixed", 12, 24)),
    ("Natal", "NATAL", ("fixed", 12, 25)),
    ("Vespera Confraternizacao Universal", "VESPERA_ANO_NOVO", ("fixed", 12, 31)),
]

# The regional holidays added to the table holidays by the
# cost forecast (date, name), duplicates kept.
REGIONAL_HOLIDAYS: list[tuple[str, str]] = [
    ("2023-08-15", "Nossa Senhora de Abadia"),
    ("2023-08-31", "Aniversário de Uberlândia"),
    ("2024-08-15", "Nossa Senhora de Abadia"),
    ("2024-08-31", "Aniversário de Uberlândia"),
    ("2025-08-15", "Nossa Senhora de Abadia"),
    ("2025-08-31", "Aniversário de Uberlândia"),
]


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter Sunday of ``year`` (anonymous computus, integer ops)."""
    y = year.cast("int")
    a = y % 19
    b = F.floor(y / 100).cast("int")
    c = y % 100
    d = F.floor(b / 4).cast("int")
    e = b % 4
    f = F.floor((b + 8) / 25).cast("int")
    g = F.floor((b - f + 1) / 3).cast("int")
    h = (19 * a + b - d - g + 15) % 30
    i = F.floor(c / 4).cast("int")
    k = c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = F.floor((a + 11 * h + 22 * l_) / 451).cast("int")
    s = h + l_ - 7 * m + 114
    return F.make_date(y, F.floor(s / 31).cast("int"), (s % 31) + 1)


def nth_weekday(year: Column, month: int, n: int, dow: int) -> Column:
    """n-th day with ``dayofweek == dow`` (1=Sunday) of the given month."""
    first = F.make_date(year.cast("int"), F.lit(month), F.lit(1))
    to_first = F.pmod(F.lit(dow) - F.dayofweek(first), F.lit(7))
    return F.date_add(first, to_first + 7 * (n - 1))


def holiday_date(year: Column, rule: tuple, easter: Column | None = None) -> Column:
    """Date of one holiday rule in ``year``; ``easter`` may pass a precomputed Easter column."""
    kind = rule[0]
    if kind == "fixed":
        return F.make_date(year.cast("int"), F.lit(rule[1]), F.lit(rule[2]))
    if kind == "easter":
        return F.date_add(easter_sunday(year) if easter is None else easter, rule[1])
    if kind == "nth_dow":
        return F.date_add(nth_weekday(year, rule[1], rule[2], rule[3]), rule[4])
    raise ValueError(f"unknown holiday rule {rule!r}")


def week_of_year_sunday(d: Column) -> Column:
    """Week number with weeks starting on Sunday; 1 Jan is always in week 1."""
    jan1 = F.trunc(d, "year")
    return (F.floor((F.dayofyear(d) + F.dayofweek(jan1) - 2) / 7) + 1).cast("int")


def week_of_month(d: Column) -> Column:
    """Week of month 1..5 (days 1-7 -> 1, ..., 29-31 -> 5)."""
    return F.ceil(F.dayofmonth(d) / 7).cast("int")


def weekday_monday0(d: Column) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.pmod(F.dayofweek(d) + 5, F.lit(7)).cast("int")


def iso_week(d: Column) -> Column:
    return F.weekofyear(d).cast("int")


def yyyymm(d: Column) -> Column:
    return (F.year(d) * 100 + F.month(d)).cast("int")


def calendar_between(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """Calendar dimension for every day of each ``[start, end]`` row of ``bounds``.

    ``bounds`` is normally a one-row frame (literal dates or an aggregate of the
    fact); the explode happens on an executor, no driver round trip.
    """
    days = bounds.select(F.explode(F.sequence(F.col(start_col).cast("date"),
                                              F.col(end_col).cast("date"))).alias("data"))
    d = F.col("data")
    return days.select(
        d,
        F.dayofmonth(d).alias("dia"),
        yyyymm(d).alias("ano_mes"),
        week_of_year_sunday(d).alias("semana_ano"),
        F.dayofweek(d).alias("dow"),
        (F.dayofmonth(d) == 1).cast("int").alias("primeiro_dia"),
        (d == F.last_day(d)).cast("int").alias("ultimo_dia"),
        week_of_month(d).alias("semana_mes"),
    )


def _holiday_sql(rule: tuple) -> str:
    """Spark SQL text of one holiday rule over columns ``_y`` (year) and ``_easter``."""
    kind = rule[0]
    if kind == "fixed":
        return f"make_date(_y, {rule[1]}, {rule[2]})"
    if kind == "easter":
        return f"date_add(_easter, {rule[1]})"
    if kind == "nth_dow":
        first = f"make_date(_y, {rule[1]}, 1)"
        return f"date_add({first}, pmod({rule[3]} - dayofweek({first}), 7) + {7 * (rule[2] - 1) + rule[4]})"
    raise ValueError(f"unknown holiday rule {rule!r}")


def holidays_for_years(years: DataFrame, year_col: str = "year") -> DataFrame:
    """Holiday table ``(data, holiday)`` for every year in ``years``.

    Easter is computed once per year, then one ``inline`` of an array of
    structs turns each year row into its 23 holidays (no union of 23 plans,
    and the generated code stays small).  The array is one SQL expression
    generated from the rule table.
    """
    with_easter = years.select(F.col(year_col).cast("int").alias("_y"),
                               easter_sunday(F.col(year_col)).alias("_easter"))
    items = ", ".join(
        "named_struct('data', {}, 'holiday', '{}')".format(_holiday_sql(rule), name.replace("'", "\\'"))
        for name, _, rule in HOLIDAYS)
    return with_easter.selectExpr(f"inline(array({items}))")


def years_between(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    return bounds.select(F.explode(F.sequence(F.year(F.col(start_col)),
                                              F.year(F.col(end_col)))).alias("year"))


def literal_bounds(spark, start: str, end: str) -> DataFrame:
    return spark.range(1).select(F.to_date(F.lit(start)).alias("start"),
                                 F.to_date(F.lit(end)).alias("end"))
