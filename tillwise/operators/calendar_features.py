"""Calendar feature table.

Every neighbour-day flag (Friday-holiday eve and day after, bridge days,
holiday eve) and every holiday one-hot is turned into ``(date, flag)`` events
in one ``inline`` over the holiday-on-calendar rows, then folded to one row
per date with a grouped ``max``.  The calendar is joined to that flag table
once, so a date carrying two holidays (or next to two) stays one row; the
per-CTE left joins of a literal translation would fan such dates out.

Both inputs are dimension-sized (days in range, years x 23 holidays), so the
joins below are broadcast with a known bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.calendar import HOLIDAYS

NEIGHBOUR_FLAGS = ["VESPERA_SEXTA", "POS_SEXTA", "BRIDGE", "VESPERA"]
HOLIDAY_FLAGS = [col for _, col, _ in HOLIDAYS]
WEEKDAY_FLAGS = [("DOM", 1), ("SEG", 2), ("TER", 3), ("QUA", 4), ("QUI", 5), ("SEX", 6), ("SAB", 7)]

CALENDAR_FEATURE_COLUMNS = (
    ["DATA", "DIA_MES", "FERIADO", "SEMANA_PASCOA", "VESPERA_SEXTA", "POS_SEXTA", "BRIDGE",
     "PRIMEIRO_DIA", "ULTIMO_DIA", "VESPERA"]
    + [name for name, _ in WEEKDAY_FLAGS]
    + ["SEMANA_MES"] + [f"SEMANA_{k}" for k in range(1, 6)]
    + HOLIDAY_FLAGS + ["ANOMES"]
)


def _event(date: Column, flag: str, cond: Column | None = None) -> Column:
    d = date if cond is None else F.when(cond, date)
    return F.struct(d.alias("data"), F.lit(flag).alias("flag"))


def holiday_flag_table(calendar: DataFrame, holidays: DataFrame) -> DataFrame:
    """One row per date that carries at least one flag; flags as 0/1 ints."""
    hol = holidays.select(F.col("data").cast("date").alias("data"), "holiday")
    on_cal = hol.join(F.broadcast(calendar.select("data", "dow")), "data")
    d, dow, named = F.col("data"), F.col("dow"), F.col("holiday").isNotNull()
    name_to_col = {name: col for name, col, _ in HOLIDAYS}
    one_hot = F.create_map(*[x for name, col in name_to_col.items() for x in (F.lit(name), F.lit(col))])
    events = on_cal.select(F.inline(F.array(
        _event(d, "FERIADO", named),
        F.struct(F.when(named, d).alias("data"), one_hot[F.col("holiday")].alias("flag")),
        _event(F.date_sub(d, 1), "VESPERA_SEXTA", named & (dow == 6)),
        _event(F.date_add(d, 1), "POS_SEXTA", named & (dow == 6)),
        _event(F.date_add(d, 1), "BRIDGE", named & (dow == 5)),
        _event(F.date_sub(d, 1), "BRIDGE", named & (dow == 3)),
        _event(F.date_sub(d, 1), "VESPERA"),
    ))).where(F.col("data").isNotNull() & F.col("flag").isNotNull())
    flags = ["FERIADO"] + NEIGHBOUR_FLAGS + HOLIDAY_FLAGS
    # SQL strings: one expression per flag instead of a chain of column calls
    return events.groupBy("data").agg(*[F.expr(f"max(CAST(flag = '{f}' AS INT)) AS {f}") for f in flags])


def easter_weeks(calendar: DataFrame, holidays: DataFrame) -> DataFrame:
    """(ano_mes, semana_ano) keys of the week before Easter's week, within Easter's month."""
    pascoa = holidays.where(F.col("holiday") == "Pascoa").select(F.col("data").cast("date").alias("data"))
    return (pascoa.join(F.broadcast(calendar.select("data", "ano_mes", "semana_ano")), "data")
            .select("ano_mes", (F.col("semana_ano") - 1).alias("semana_ano"))
            .distinct().withColumn("in_easter_week", F.lit(1)))


def calendar_features(calendar: DataFrame, holidays: DataFrame,
                      start: Column | str | None = None, end: Column | str | None = None) -> DataFrame:
    """Calendar dimension -> feature table, one row per day in ``[start, end]``.

    Flags are computed on the whole calendar first; only the output rows are
    restricted to the range, so days at the range edges keep flags caused by
    holidays just outside it.
    """
    flags = holiday_flag_table(calendar, holidays)
    weeks = easter_weeks(calendar, holidays)
    cal = calendar
    if start is not None:
        cal = cal.where(F.col("data") >= (F.to_date(F.lit(start)) if isinstance(start, str) else start))
    if end is not None:
        cal = cal.where(F.col("data") <= (F.to_date(F.lit(end)) if isinstance(end, str) else end))
    joined = (cal.join(F.broadcast(flags), "data", "left")
              .join(F.broadcast(weeks), ["ano_mes", "semana_ano"], "left"))

    def flag(name: str) -> str:
        return f"coalesce({name}, 0) AS {name}"

    # generated columns as SQL strings (one expression each, same types as column calls)
    cols = ["data AS DATA", "dia AS DIA_MES", flag("FERIADO"),
            "CAST(coalesce(PASCOA, 0) = 1 OR in_easter_week IS NOT NULL AS INT) AS SEMANA_PASCOA",
            flag("VESPERA_SEXTA"), flag("POS_SEXTA"), flag("BRIDGE"),
            "primeiro_dia AS PRIMEIRO_DIA", "ultimo_dia AS ULTIMO_DIA", flag("VESPERA")]
    cols += [f"CAST(dow = {k} AS INT) AS {name}" for name, k in WEEKDAY_FLAGS]
    cols += ["semana_mes AS SEMANA_MES"]
    cols += [f"CAST(semana_mes = {k} AS INT) AS SEMANA_{k}" for k in range(1, 6)]
    cols += [flag(c) for c in HOLIDAY_FLAGS]
    cols += ["ano_mes AS ANOMES"]
    return joined.selectExpr(*cols)
