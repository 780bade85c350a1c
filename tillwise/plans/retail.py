"""Retail sales forecast inputs: label registry, splits, outliers, features.

The ABT is wide (one row per day, one column per value); the model side works
on a long frame ``(series, DATA, y, calendar columns...)`` so that every step
is grouped or partitioned by ``series`` and a panel of many series runs in
parallel instead of one series after another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.functions.columns import outlier_class
from tillwise.functions.date_features import DATE_PART_NAMES, date_part_columns, override_outlier
from tillwise.operators.metrics import regression_metrics
from tillwise.operators.outliers import choose_bounds, series_bounds
from tillwise.plans.abt import ABT_START, abt_daily

FORECAST_AS_OF = "2001-07-15"

_COMMON = ["DIA_SEMANA", "TRIMESTRE", "MES", "ANO", "DIA_ANO", "DIA_MES", "SEMANA_ANO", "FERIADO",
           "ULTIMO_DIA", "PRIMEIRO_DIA", "SEMANA_MES"]
_HOLIDAY_FEATURES = ["ANO_NOVO", "CARNAVAL1", "CARNAVAL2", "CARNAVAL3", "PAIXAO_CRISTO", "PASCOA",
                     "TIRADENTES", "DIA_DO_TRABALHO", "VESPERA_MAES", "DIA_DAS_MAES", "CORPUS_CHRISTI",
                     "DIA_DOS_PAIS", "INDEPENDENCIA", "APARECIDA", "FINADOS", "PROC_REPUBLICA",
                     "BLACK_THURSDAY", "BLACK_FRIDAY", "VESPERA_NATAL", "NATAL", "VESPERA_ANO_NOVO"]

# Model feature list per label, outlier method per label,
# whether the test-set outlier flag is reset to 0 at scoring, and the metric
# that picks the refit parameters.
LABELS: dict[str, dict] = {
    "VALOR_SMART_TOTAL": {
        "bounds": "quantile",
        "reset_test_outlier": True,
        "refit": "MAPE",
        "features": _COMMON + ["VESPERA", "BRIDGE"] + _HOLIDAY_FEATURES
        + ["OUTLIER", "POS_SEXTA", "VESPERA_SEXTA", "SEX", "SAB", "DOM", "PIX_CATEG"],
    },
    "VALOR_TOTAL": {
        "bounds": "tukey",
        "reset_test_outlier": False,
        "refit": "MAPE",
        "features": _COMMON + ["BRIDGE", "VESPERA"] + _HOLIDAY_FEATURES
        + ["OUTLIER", "SEX", "SAB", "DOM", "SEMANA_PASCOA", "POS_SEXTA", "VESPERA_SEXTA", "PIX_CATEG"],
    },
}

# Calendar columns carried from the ABT into the long frame (the date parts
# are recomputed from DATA by ``date_part_columns``).
CARRIED = ["FERIADO", "ULTIMO_DIA", "PRIMEIRO_DIA", "SEMANA_MES", "VESPERA", "BRIDGE", "SEMANA_PASCOA",
           "POS_SEXTA", "VESPERA_SEXTA", "PIX_CATEG"] + _HOLIDAY_FEATURES


def label_spec(label: str) -> dict:
    try:
        return LABELS[label]
    except KeyError:
        raise ValueError(f"Invalid label {label!r}; known: {sorted(LABELS)}") from None


def feature_columns(label: str) -> list[str]:
    return list(label_spec(label)["features"])


def _method_col(series: F.Column, key: str) -> F.Column:
    expr = None
    for name, spec in LABELS.items():
        expr = (F.when(series == name, F.lit(spec[key])) if expr is None
                else expr.when(series == name, F.lit(spec[key])))
    return expr


def long_series(abt: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Wide ABT -> (series, DATA, y, carried calendar columns) for the given labels."""
    labels = labels or list(LABELS)
    for lab in labels:
        label_spec(lab)
    carried = [c for c in CARRIED if c in abt.columns]
    stacked = F.inline(F.array(*[
        F.struct(F.lit(lab).alias("series"), F.col(lab).cast("double").alias("y")) for lab in labels]))
    return abt.select("DATA", *carried, stacked)


def split_months(df: DataFrame, as_of: str, date_col: str = "DATA") -> DataFrame:
    """P13 split: train before the month preceding ``as_of``; that whole month is the test."""
    a = F.to_date(F.lit(as_of))
    test_start = F.trunc(F.add_months(a, -1), "MM")
    d = F.col(date_col)
    split = F.when(d < test_start, F.lit("train")).when(d <= F.last_day(test_start), F.lit("test"))
    return df.withColumn("split", split).where(F.col("split").isNotNull())


def holdout_days(df: DataFrame, as_of: str, days: int = 31, date_col: str = "DATA",
                 value_col: str = "y") -> DataFrame:
    """Drop incomplete rows and today onward; test = the ``days`` days before ``as_of``."""
    a = F.to_date(F.lit(as_of))
    d = F.col(date_col)
    clean = df.na.drop("any", subset=[date_col, value_col]).where(d < a)
    split = F.when(d < F.date_sub(a, days), F.lit("train")).otherwise(F.lit("test"))
    return clean.withColumn("split", split)


def add_outlier(long_split: DataFrame, reference_mode: bool = False) -> DataFrame:
    """C9 + C11 + C13: outlier class against train bounds, then special-date codes.

    At scoring (test rows) the class is calendar-only by default: the test
    actuals are not used.  ``reference_mode=True`` reproduces the original
    behaviour: test rows classified by their own actuals, and labels marked
    ``reset_test_outlier`` set to 0 on test rows after the overrides.
    """
    train = long_split.where(F.col("split") == "train")
    bounds = series_bounds(train, ["series"], "y")
    j = long_split.join(bounds, "series", "left")
    lower, upper = choose_bounds(_method_col(F.col("series"), "bounds"))
    base = outlier_class(F.col("y"), lower, upper)
    is_test = F.col("split") == "test"
    if not reference_mode:
        base = F.when(is_test, F.lit(0)).otherwise(base)
    out = override_outlier(F.col("DATA"), base)
    if reference_mode:
        out = F.when(is_test & _method_col(F.col("series"), "reset_test_outlier"), F.lit(0)).otherwise(out)
    return j.withColumn("OUTLIER", out.cast("int")).drop(*[c for c in bounds.columns if c != "series"])


def add_date_parts(df: DataFrame, group: list[str], special: bool = True) -> DataFrame:
    """C10 + C11 + C12: date parts (``special``: with overrides); DECORRIDO = max(DATA) of the group - DATA."""
    if group:  # one row per group; the number of series is not bounded, so AQE picks the join
        j = df.join(df.groupBy(*group).agg(F.max("DATA").alias("_last")), group)
    else:
        j = df.withColumn("_last", df.agg(F.max("DATA")).scalar())
    parts = date_part_columns(F.col("DATA"), F.col("PRIMEIRO_DIA"), special)
    keep = [c for c in df.columns if c not in DATE_PART_NAMES]
    return j.select(*keep, *parts, F.datediff(F.col("_last"), F.col("DATA")).alias("DECORRIDO"))


def add_folds(train: DataFrame, k: int = 5, keys: list[str] | None = None, order: str = "DATA") -> DataFrame:
    """M3: contiguous unshuffled folds 0..k-1 in date order per series (sizes as KFold)."""
    keys = keys or ["series"]
    w = Window.partitionBy(*keys).orderBy(order)
    return train.withColumn("fold", (F.ntile(k).over(w) - 1).cast("int"))


def seasonal_naive(long_df: DataFrame, lag_days: int = 7) -> DataFrame:
    """Forecast y(t) by y(t - lag_days) of the same series (a self-join on date, not a window
    over rows, so missing days give no forecast instead of a wrong neighbour)."""
    past = long_df.select("series", F.date_add("DATA", lag_days).alias("DATA"), F.col("y").alias("yhat"))
    return long_df.join(past, ["series", "DATA"], "inner")


# --------------------------------------------------------------------------- registered jobs
def _long_abt(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    return long_series(abt_daily(spark, sf_dir, as_of=as_of, start=ABT_START, persist=True))


def _split_long(spark: SparkSession, sf_dir: str, as_of: str = FORECAST_AS_OF) -> DataFrame:
    return split_months(_long_abt(spark, sf_dir, as_of), as_of)


def outlier_bounds_q(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    train = _split_long(spark, sf_dir).where(F.col("split") == "train")
    b = series_bounds(train, ["series"], "y")
    if method == "quantile":
        return b.select("series", F.round("q_li", 6).alias("li"), F.round("q_ls", 6).alias("ls"))
    return b.select("series", F.round("q1", 6).alias("q1"), F.round("q3", 6).alias("q3"),
                    F.round("t_li", 6).alias("li"), F.round("t_ls", 6).alias("ls"))


def outlier_class_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_outlier(_split_long(spark, sf_dir)).select("series", "DATA", "split", "y", "OUTLIER")


def date_part_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _split_long(spark, sf_dir)
    feats = add_date_parts(df, ["series", "split"])
    return feats.select("series", "DATA", "split", *DATE_PART_NAMES, "DECORRIDO")


def date_holdout_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    long_df = _long_abt(spark, sf_dir, FORECAST_AS_OF)
    return holdout_days(long_df, FORECAST_AS_OF).select("series", "DATA", "y", "split")


def contiguous_folds_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _split_long(spark, sf_dir).where(F.col("split") == "train")
    return add_folds(train).select("series", "DATA", "fold")


def seasonal_naive_metrics_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    long_df = _split_long(spark, sf_dir)
    scored = seasonal_naive(long_df).where(F.col("split") == "test")
    m = regression_metrics(scored, ["series"])
    return m
