"""Model jobs: additive forecaster tuning and forecasts (M8-M12), boosted-tree regression
with contiguous-fold grid search (M1-M7), text classifier with calibrated confidence (M13-M16).

Training results have no SQL oracle; tests check them with planted signals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.columns import clip_below_zero
from tillwise.operators import additive
from tillwise.operators.upsert import merge_frames
from tillwise.plans.abt import ABT_START, abt_daily, holiday_union_q, holidays_for_span
from tillwise.plans.billing import global_cost_series
from tillwise.plans.retail import FORECAST_AS_OF, long_series
from tillwise.session import per_application

COST_AS_OF, COST_PREVIOUS_RUN = "2024-01-31", "2024-01-24"
COST_HOLDOUT_DAYS = 7  # the billing stand-in covers 30 days; a 31-day holdout would leave no training data


def _retail_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    long_df = long_series(abt_daily(spark, sf_dir, as_of=FORECAST_AS_OF, start=ABT_START, persist=True))
    series = long_df.select("series", F.col("DATA").alias("ds"), "y")
    return additive.prepare_history(series, holiday_union_q(spark, sf_dir), FORECAST_AS_OF)


def tune_additive_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: holdout MAPE of all 75 parameter sets for each retail series."""
    return additive.tune(_retail_history(spark, sf_dir), FORECAST_AS_OF)


def additive_forecast_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best parameters per series, refit, history + 30 days with the 80 % band."""
    hist = _retail_history(spark, sf_dir).cache()
    best = additive.best_parameters(additive.tune(hist, FORECAST_AS_OF))
    fc = additive.forecast(hist, best, holiday_union_q(spark, sf_dir))
    return fc.join(hist.select("series", "ds", "y"), ["series", "ds"], "left")


def additive_tracking_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M17 with the trained model: the tracked month's first forecast, daily re-forecasts and actuals."""
    from calendar import monthrange

    from tillwise.plans.tracking import TRACK_MONTH

    year, month = (int(x) for x in TRACK_MONTH.split("-")[:2])
    last = f"{TRACK_MONTH[:8]}{monthrange(year, month)[1]:02d}"
    long_df = long_series(abt_daily(spark, sf_dir, as_of=FORECAST_AS_OF, start=ABT_START, persist=True))
    series = long_df.select("series", F.col("DATA").alias("ds"), "y")
    holidays = holiday_union_q(spark, sf_dir)
    best = additive.best_parameters(additive.tune(additive.prepare_history(series, holidays, TRACK_MONTH), TRACK_MONTH))
    return additive.track(series, best, holidays, TRACK_MONTH, last)


def forecast_result(fc: DataFrame, history: DataFrame, as_of: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """J10 + M12: ``keep`` columns and the target-table shape (data, previsao, real, bands; lower band
    clipped), rows >= as_of."""
    j = fc.join(history.select("series", "ds", F.col("y").alias("real")), ["series", "ds"], "left")
    return j.where(F.col("ds") >= F.to_date(F.lit(as_of))).select(
        *keep, F.col("ds").alias("data"), F.col("yhat").alias("previsao"), "real",
        F.col("yhat_upper").alias("previsao_superior"),
        clip_below_zero(F.col("yhat_lower")).cast("double").alias("previsao_inferior"))


def cost_forecast_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 end to end: priced usage -> 'ALL' daily cost -> tune -> refit -> result rows merged
    into the target that a run a week earlier left: its later days are updated, new days added."""
    series = global_cost_series(spark, sf_dir).select(F.lit("ALL").alias("series"), "ds", "y")
    hol = holidays_for_span(series, "ds")
    hist = additive.prepare_history(series, hol, COST_AS_OF).cache()
    best = additive.best_parameters(additive.tune(hist, COST_AS_OF, holdout_days=COST_HOLDOUT_DAYS))
    fc = additive.forecast(hist, best, hol)
    source = forecast_result(fc, hist, COST_AS_OF)
    before = hist.where(F.col("ds") < F.to_date(F.lit(COST_PREVIOUS_RUN)))
    previous = forecast_result(additive.forecast(before, best, hol), before, COST_PREVIOUS_RUN)
    return merge_frames(previous, source, ["data"])


# --------------------------------------------------------------------------- boosted trees (M1-M7)
def retail_model_frame(spark: SparkSession, sf_dir: str | None, abt: DataFrame | None = None,
                       as_of: str = FORECAST_AS_OF) -> DataFrame:
    """Long rows of every label with model features: date parts, outlier class, train folds.
    ``abt`` takes a feature table built by the caller (``build_abt``); else the test data's."""
    from tillwise.plans.retail import _split_long, add_date_parts, add_folds, add_outlier, split_months
    split = _split_long(spark, sf_dir) if abt is None else split_months(long_series(abt), as_of)
    df = add_outlier(split)
    df = add_date_parts(df, ["series", "split"])
    train = add_folds(df.where(F.col("split") == "train"))
    test = df.where(F.col("split") == "test").withColumn("fold", F.lit(-1))
    return train.unionByName(test)


def train_retail_gbt(spark: SparkSession, sf_dir: str | None, grid: list[dict] | None = None,
                     abt: DataFrame | None = None, as_of: str = FORECAST_AS_OF):
    """``train_labels`` on the feature table of the caller or of the test data."""
    from tillwise.operators import boosted
    from tillwise.plans.retail import LABELS

    return train_labels(spark, retail_model_frame(spark, sf_dir, abt, as_of), LABELS, {label: grid or boosted.FULL_GRID for label in LABELS})


def train_labels(spark: SparkSession, rows: DataFrame, labels: dict[str, dict], grids: dict[str, list[dict]]):
    """All labels: CV over their grids, refit the winners on all training days, score the test days.

    ``labels`` names each label's features and refit metric, ``grids`` its search space.
    Returns (predictions, importances, fold-mean metrics) DataFrames; the fitted rows are
    written in the shared folder, so nothing is fitted twice."""
    from functools import reduce

    from tillwise.operators import boosted
    from tillwise.operators.linear_margins import saved

    frame = saved(rows.where(F.col("series").isin(list(labels))), "model-frame")
    feats = {label: list(spec["features"]) for label, spec in labels.items()}
    means = saved(boosted.fold_means(boosted.cross_validate(frame, feats, grids), ["series"]), "fold-means")
    best = reduce(DataFrame.unionByName, (boosted.choose(means.where(F.col("series") == label), spec["refit"], ["series"]) for label, spec in labels.items()))
    chosen = {r["series"]: r["param_id"] for r in best.collect()}  # a series without training days has no model
    if not chosen:
        raise ValueError("no label has training days")
    fitted = saved(boosted.refit(frame, feats, grids, chosen), "refitted")
    preds = fitted.where(F.col("feature").isNull()).select("series", "DATA", "y", F.col("value").alias("PREVISAO"), "param_id")
    names = spark.createDataFrame([(label, i, f) for label, own in feats.items() for i, f in enumerate(own)], "series string, feature int, name string")
    imps = fitted.where(F.col("feature").isNotNull()).join(F.broadcast(names), ["series", "feature"]).select("series", F.col("name").alias("feature"), F.col("value").alias("importance"))
    return preds, imps, means


def _trained_gbt(spark: SparkSession, sf_dir: str):
    def build():
        return train_retail_gbt(spark, sf_dir)

    return per_application(spark, ("retail_gbt", sf_dir), build)


def gbt_forecast_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M5, M7: test-month predictions of each label's chosen model."""
    return _trained_gbt(spark, sf_dir)[0]


def feature_importance_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: feature importances of each label's chosen model."""
    return _trained_gbt(spark, sf_dir)[1]


def assemble_forecasts(preds: DataFrame) -> DataFrame:
    """M7: one row per date with one prediction column per label (labels from the registry,
    so the pivot needs no extra pass to discover them)."""
    from tillwise.plans.retail import LABELS
    return preds.groupBy("DATA").pivot("series", list(LABELS)).agg(F.first("PREVISAO"))


def run_cost_forecast_job(spark: SparkSession, sf_dir: str | None, target_base: str, as_of: str = COST_AS_OF,
                          usage: DataFrame | None = None, prices: DataFrame | None = None,
                          holdout_days: int = COST_HOLDOUT_DAYS) -> None:
    """E2 as a job: tune, refit and forecast the 'ALL' cost series, keep rows dated on or
    after ``as_of`` and MERGE them into the target table (by months) on ``data`` (S10).
    ``usage`` / ``prices`` take the billing system tables as they are; with a long
    history use the original 31-day holdout."""
    from tillwise.operators.upsert import upsert_partitions
    from tillwise.plans.billing import ALL, daily_with_rollup, price_usage

    if usage is None:
        daily = global_cost_series(spark, sf_dir)
    else:
        daily = (daily_with_rollup(price_usage(usage, prices)).where(F.col("sku") == ALL)
                 .select("ds", F.col("custo").alias("y")))
    series = daily.select(F.lit("ALL").alias("series"), "ds", "y")
    hol = holidays_for_span(series, "ds")
    hist = additive.prepare_history(series, hol, as_of).cache()
    best = additive.best_parameters(additive.tune(hist, as_of, holdout_days=holdout_days))
    source = forecast_result(additive.forecast(hist, best, hol), hist, as_of)
    upsert_partitions(source, target_base, ["data"], "data")


def run_retail_forecast_job(spark: SparkSession, sf_dir: str | None, run_log_path: str,
                            abt: DataFrame | None = None, as_of: str = FORECAST_AS_OF,
                            grid: list[dict] | None = None) -> DataFrame:
    """E1 as a job: per label, grid search on contiguous folds, refit, score the test month;
    the chosen parameters and their fold-mean metrics are appended to the run log (S12).
    ``abt`` takes the caller's feature table (``build_abt``); else the test data's."""
    from tillwise.operators.boosted import FULL_GRID, METRICS
    from tillwise.sources.sinks import append_run_log, run_log_rows

    grid = grid or FULL_GRID  # the original 54-combination search space
    if abt is None and grid is FULL_GRID:
        preds, _, means = _trained_gbt(spark, sf_dir)
    else:
        preds, _, means = train_retail_gbt(spark, sf_dir, grid=grid, abt=abt, as_of=as_of)
    chosen = preds.select("series", "param_id").distinct()
    best = means.join(chosen, ["series", "param_id"])
    grid_cols = sorted({k for g in grid for k in g})
    grid_df = spark.createDataFrame(
        [(i, *[str(g.get(k, "")) for k in grid_cols]) for i, g in enumerate(grid)],
        ", ".join(["param_id int"] + [f"{k} string" for k in grid_cols]))
    rows = run_log_rows(best.join(F.broadcast(grid_df), "param_id"), as_of, ["param_id", *grid_cols], METRICS)
    append_run_log(rows, run_log_path)
    return preds


def gbt_forecast_wide_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: the test-month forecast assembled per date, one prediction column per label."""
    return assemble_forecasts(_trained_gbt(spark, sf_dir)[0])
