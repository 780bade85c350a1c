"""Registry of runnable queries (name -> Spark builder) and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwise import oracle as O
from tillwise.session import apply_job_conf
from tillwise.plans import abt

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, builder: Builder, sql: str | None = None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_job_conf(spark)  # UTC day boundaries, AQE: whatever session the caller brings
        return builder(spark, sf_dir)

    run.__name__ = name
    run.__doc__ = builder.__doc__
    QUERIES[name] = run
    if sql is not None:
        ORACLES[name] = sql


AS_OF = abt.COHORT_AS_OF
START = abt.ABT_START

register("abt_daily", abt.abt_daily, O.abt_daily_sql(AS_OF, START))
register("same_store_panel", abt.same_store_panel_q, O.same_store_panel_sql(AS_OF))
register("daily_value_by_segment", abt.daily_value_by_segment_q, O.daily_value_by_segment_sql(AS_OF))
register("calendar_features", abt.calendar_features_q, O.calendar_features_data_sql())
register("holiday_union", abt.holiday_union_q, O.holiday_union_sql())
register("holiday_table", abt.holiday_table_q, O.holiday_union_sql())

from tillwise.plans import billing  # noqa: E402

register("priced_usage", billing.priced_usage_q, O.priced_usage_sql())
register("sku_family_daily", billing.sku_family_daily_q, O.sku_family_daily_sql())
register("daily_rollup_all", billing.daily_rollup_all_q, O.daily_rollup_all_sql())

from tillwise.plans import retail  # noqa: E402

FC = retail.FORECAST_AS_OF
register("outlier_bounds_quantile", lambda s, d: retail.outlier_bounds_q(s, d, "quantile"),
         O.outlier_bounds_sql(FC, START, "quantile"))
register("outlier_bounds_tukey", lambda s, d: retail.outlier_bounds_q(s, d, "tukey"),
         O.outlier_bounds_sql(FC, START, "tukey"))
register("outlier_class", retail.outlier_class_q, O.outlier_class_sql(FC, START))
register("date_part_features", retail.date_part_features_q, O.date_part_features_sql(FC, START))
register("date_holdout_split", retail.date_holdout_split_q, O.date_holdout_split_sql(FC, START))
register("contiguous_folds", retail.contiguous_folds_q, O.contiguous_folds_sql(FC, START))
register("seasonal_naive_metrics", retail.seasonal_naive_metrics_q, O.seasonal_naive_metrics_sql(FC, START))

from tillwise.plans import text  # noqa: E402

register("clean_text", text.clean_text_q, O.clean_text_sql())
register("token_ngrams", text.token_ngrams_q, O.token_ngrams_sql())
register("tfidf_long", text.tfidf_long_q, O.tfidf_long_sql())
register("label_index", text.label_index_q, O.label_index_sql())
register("threshold_sweep", text.threshold_sweep_q, O.threshold_sweep_only_sql())
register("best_threshold", text.best_threshold_q, O.best_threshold_sql())

from tillwise.operators import flyer as FL  # noqa: E402
from tillwise.plans import flyer  # noqa: E402

register("top_sellers", flyer.top_sellers_q, O.top_sellers_sql())
register("party_split", flyer.party_split_q, O.party_split_sql())
register("price_request", flyer.price_request_q, O.price_request_sql(flyer.PAGE_SIZE))
register("pref_ingest", flyer.pref_ingest_q, O.pref_ingest_sql())
register("resolve_prices", flyer.resolve_prices_q, O.resolve_prices_sql())
register("flyer_feed", flyer.flyer_feed_q, O.flyer_feed_sql(FL.CAPTION_WIDTH, FL.CAPTION_LINES))
register("wrap_caption", flyer.wrap_caption_q, O.wrap_caption_sql(FL.CAPTION_WIDTH, FL.CAPTION_LINES))

from tillwise.plans import tracking  # noqa: E402

register("upsert_forecast", tracking.upsert_forecast_q,
         O.upsert_forecast_sql(FC, START, tracking.UPSERT_FIRST_RUN, tracking.UPSERT_SECOND_RUN))
register("forecast_result", tracking.forecast_result_q,
         O.forecast_result_sql(FC, START, tracking.UPSERT_FIRST_RUN, tracking.UPSERT_SECOND_RUN, tracking.RESULT_FROM))
register("forecast_tracking", tracking.forecast_tracking_q, O.forecast_tracking_sql(FC, START, tracking.TRACK_MONTH))
register("best_params", tracking.best_params_q, O.best_params_sql(FC, START, tracking.LAG_GRID))
register("run_log", tracking.run_log_q, O.run_log_sql(FC, START, tracking.LAG_GRID))
register("csv_roundtrip", tracking.csv_roundtrip_q, O.csv_roundtrip_sql(FC, START))

from tillwise.plans import models  # noqa: E402

register("tune_additive", models.tune_additive_q)
register("additive_forecast", models.additive_forecast_q)
register("additive_tracking", models.additive_tracking_q)
register("cost_forecast", models.cost_forecast_q)
register("gbt_forecast", models.gbt_forecast_q)
register("feature_importance", models.feature_importance_q)
register("gbt_forecast_wide", models.gbt_forecast_wide_q)
register("bayes_classifier", text.bayes_classifier_q, O.bayes_classifier_sql())
register("classifier_accuracy", text.classifier_accuracy_q, O.classifier_accuracy_sql())
register("text_classifier", text.text_classifier_q)
register("linear_scores", text.linear_scores_q, O.linear_scores_sql())
register("platt_step", text.platt_step_q, O.platt_step_sql())
register("classifier_threshold", text.classifier_threshold_q)
register("text_classifier_gbt", text.text_classifier_gbt_q)

from tillwise.plans import csv_forecast as CF  # noqa: E402

register("rede_features", CF.rede_features_q, O.rede_features_sql(FC, START, CF.TEST_FROM, CF.LAST_DAY))
register("csv_forecast_inputs", CF.csv_forecast_inputs_q, O.csv_forecast_inputs_sql(FC, START, CF.TEST_FROM, CF.LAST_DAY))
register("csv_forecast", CF.csv_forecast_q)
