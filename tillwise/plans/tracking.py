"""Forecast bookkeeping jobs: upsert (S10, P9, P14), tracking (M17), grid choice (A15, A19),
CSV round trip (S3, S11) and the run log (S12).

They use a seasonal-naive forecaster (same weekday, last observed week) so
the bookkeeping can be checked exactly against SQL; the trained models in
``plans.models`` produce frames of the same shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.columns import clip_below_zero
from tillwise.operators.metrics import regression_metrics
from tillwise.operators.upsert import merge_frames
from tillwise.plans.abt import ABT_START, abt_daily
from tillwise.plans.retail import FORECAST_AS_OF, _split_long, add_folds, long_series
from tillwise.sources.sinks import read_csv_dated, run_log_rows, scratch_dir, write_csv

# Two-sided 80 % band of a normal error (z = 1.2816), the
# forecast horizon in days, and the lag grid searched by ``best_params``.
BAND_Z = 1.2816
HORIZON = 30
LAG_GRID = [7, 14, 21, 28, 364]

UPSERT_FIRST_RUN = "2001-06-01"
UPSERT_SECOND_RUN = "2001-06-15"
RESULT_FROM = "2001-06-08"
TRACK_MONTH = "2001-06-01"


def weekly_spread(long_df: DataFrame, before: str) -> DataFrame:
    """(series) -> mean |y(t) - y(t-7)| over days before ``before`` (exact decimal sums)."""
    h = long_df.where(F.col("DATA") < F.to_date(F.lit(before))).select("series", "DATA", "y")
    prev = h.select("series", F.date_add("DATA", 7).alias("DATA"), F.col("y").alias("y7"))
    d = F.abs(F.col("y").cast("decimal(38,2)") - F.col("y7").cast("decimal(38,2)"))
    return (h.join(prev, ["series", "DATA"])
            .groupBy("series").agg((F.sum(d).cast("double") / F.count(F.lit(1)).cast("double")).alias("spread")))


def naive_forecasts(long_df: DataFrame, runs: DataFrame, horizon: int = HORIZON,
                    spread_before: str | None = None) -> DataFrame:
    """(series, run_date, data, previsao, real, previsao_superior, previsao_inferior).

    For run date r the forecast of day d (r <= d < r + horizon) is the value of
    the latest same-weekday day before r; ``real`` is known only for d < r.
    The targets frame (runs x horizon) is tiny and broadcast; the history is
    joined on its date, so every series is forecast without a cross join.
    """
    targets = runs.select("run_date", F.explode(F.sequence(
        F.col("run_date"), F.date_add("run_date", horizon - 1))).alias("data"))
    k = F.ceil((F.datediff("data", "run_date") + 1) / 7).cast("int")
    targets = targets.withColumn("src", F.date_sub("data", 7 * k))
    hist = long_df.select("series", F.col("DATA").alias("src"), F.col("y").alias("previsao"))
    fc = hist.join(F.broadcast(targets), "src")
    actual = long_df.select("series", F.col("DATA").alias("data"), F.col("y").alias("_y"))
    spread = weekly_spread(long_df, spread_before) if spread_before else None
    out = fc.join(actual, ["series", "data"], "left")
    if spread is not None:
        out = out.join(spread, "series", "left")
    else:
        out = out.withColumn("spread", F.lit(0.0))
    band = F.lit(BAND_Z) * F.col("spread")
    return out.select(
        "series", "run_date", "data", "previsao",
        F.when(F.col("data") < F.col("run_date"), F.col("_y")).alias("real"),
        (F.col("previsao") + band).alias("previsao_superior"),
        (F.col("previsao") - band).alias("previsao_inferior"))


def _runs(spark: SparkSession, dates: list[str]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in dates], "d string").select(F.to_date("d").alias("run_date"))


def _retail_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_series(abt_daily(spark, sf_dir, as_of=FORECAST_AS_OF, start=ABT_START, persist=True))


def forecast_rows(fc: DataFrame) -> DataFrame:
    """M12 shape: target table columns, lower band clipped at 0 (NULL kept)."""
    return fc.select("series", "data", "previsao", "real", "previsao_superior",
                     clip_below_zero(F.col("previsao_inferior")).cast("double").alias("previsao_inferior"))


def upsert_forecast_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table holding the first run's forecasts of all series, merged on (series, data) with
    the second run's rows dated on or after the second run (P9)."""
    long_df = _retail_long(spark, sf_dir)
    fc = naive_forecasts(long_df, _runs(spark, [UPSERT_FIRST_RUN, UPSERT_SECOND_RUN]),
                         spread_before=UPSERT_FIRST_RUN)
    target = forecast_rows(fc.where(F.col("run_date") == F.to_date(F.lit(UPSERT_FIRST_RUN))))
    source = forecast_rows(fc.where((F.col("run_date") == F.to_date(F.lit(UPSERT_SECOND_RUN)))
                                    & (F.col("data") >= F.to_date(F.lit(UPSERT_SECOND_RUN)))))
    return merge_frames(target, source, ["series", "data"])


def forecast_result_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J10 + M12: the first run's forecasts from a later day on, next to the values known at the second run."""
    from tillwise.plans.models import forecast_result

    long_df = _retail_long(spark, sf_dir)
    fc = naive_forecasts(long_df, _runs(spark, [UPSERT_FIRST_RUN]), spread_before=UPSERT_FIRST_RUN).select(
        "series", F.col("data").alias("ds"), F.col("previsao").alias("yhat"),
        F.col("previsao_superior").alias("yhat_upper"), F.col("previsao_inferior").alias("yhat_lower"))
    known = long_df.where(F.col("DATA") < F.to_date(F.lit(UPSERT_SECOND_RUN))).select("series", F.col("DATA").alias("ds"), "y")
    return forecast_result(fc, known, RESULT_FROM, keep=("series",))


def forecast_tracking_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per series and day of the month: forecast of the run on the 1st, forecast of
    the last run before the day (data to d-1), and the realised value."""
    long_df = _retail_long(spark, sf_dir)
    month = F.to_date(F.lit(TRACK_MONTH))
    runs = spark.range(1).select(F.explode(F.sequence(month, F.last_day(month))).alias("run_date"))
    fc = naive_forecasts(long_df, runs).where(F.col("data") <= F.last_day(month))
    track = fc.groupBy("series", "data").agg(
        F.min_by("previsao", "run_date").alias("previsao_inicial"),
        F.max_by("previsao", "run_date").alias("previsao_ajustada"))
    actual = long_df.select("series", F.col("DATA").alias("data"), F.col("y").alias("real"))
    return track.join(actual, ["series", "data"], "left")


def cv_lag_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (series, lag, fold) metrics of the seasonal forecast y(t - lag) on contiguous folds."""
    split = _split_long(spark, sf_dir)
    train = add_folds(split.where(F.col("split") == "train"))
    grid = train.select("series", "DATA", "y", "fold",
                        F.explode(F.array(*[F.lit(g) for g in LAG_GRID])).alias("lag"))
    hist = split.select("series", F.col("DATA").alias("src"), F.col("y").alias("yhat"))
    scored = grid.withColumn("src", F.expr("date_sub(DATA, lag)")).join(hist, ["series", "src"])
    return regression_metrics(scored, ["series", "lag", "fold"])


def best_params_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A19 + A15: fold-mean metrics per lag, then the lag with the lowest MAPE (ties: smaller lag)."""
    m = cv_lag_metrics(spark, sf_dir)
    means = m.groupBy("series", "lag").agg(*[F.avg(c).alias(c) for c in ["MAE", "MSE", "RMSE", "R2", "MAPE"]])
    rounded = means.select("series", "lag", F.round("MAE", 6).alias("MAE"), F.round("MSE", 2).alias("MSE"),
                           F.round("RMSE", 6).alias("RMSE"), F.round("R2", 9).alias("R2"),
                           F.round("MAPE", 9).alias("MAPE"))
    payload = F.struct("lag", "MAE", "MSE", "RMSE", "R2", "MAPE")
    return (rounded.groupBy("series").agg(F.min_by(payload, F.struct("MAPE", "lag")).alias("b"))
            .select("series", "b.*"))


def run_log_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid choice of each series as run-log rows (params and metrics maps)."""
    best = best_params_q(spark, sf_dir)
    return run_log_rows(best, FORECAST_AS_OF, ["lag"], ["MAE", "MSE", "RMSE", "R2", "MAPE"])


CSV_SCHEMA = T.StructType([T.StructField("DATA", T.StringType()),
                           T.StructField("VALOR_TOTAL", T.DoubleType()),
                           T.StructField("VALOR_SMART_TOTAL", T.DoubleType())])


def csv_roundtrip_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11 then S3: ABT values written as CSV with dd-mm-yy dates and read back."""
    abt = abt_daily(spark, sf_dir, as_of=FORECAST_AS_OF, start=ABT_START, persist=True)
    out = abt.select(F.date_format("DATA", "dd-MM-yy").alias("DATA"), "VALOR_TOTAL", "VALOR_SMART_TOTAL")
    path = scratch_dir(spark, "abt-csv")
    write_csv(out, path)
    return read_csv_dated(spark, path, CSV_SCHEMA, "DATA")
