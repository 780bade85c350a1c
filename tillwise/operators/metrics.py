"""Forecast accuracy metrics (A11, A12, A15, A19) as one grouped aggregation.

Sums are taken in double at the data's full precision; only the finished
metrics are cut to ``DIGITS`` significant digits, which hides the order that
partial sums were combined in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = 10


def significant(c: Column) -> Column:
    """``c`` to ``DIGITS`` significant digits; null stays null."""
    return F.when(c.isNotNull(), F.format_string(f"%.{DIGITS - 1}e", c).cast("double"))


def regression_metrics(df: DataFrame, keys: list[str], y: str = "y", yhat: str = "yhat") -> DataFrame:
    """keys -> n, MAE, MSE, RMSE, R2, MAPE (percent), n_zero_actual.

    MAPE follows the cost forecast: ``mean(|(y - |yhat|) / y|) * 100``; days
    with y = 0 have no finite term, are counted in ``n_zero_actual`` and left
    out of the mean (ANSI division by zero would fail the job otherwise).
    R2 is null where the actual values do not vary.
    """
    both = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    actual, forecast = F.col(y).cast("double"), F.col(yhat).cast("double")
    miss = actual - forecast
    share = F.when(actual != 0, F.abs((actual - F.abs(forecast)) / F.nullif(actual, F.lit(0.0))))
    agg = both.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(miss)).alias("MAE"),
        F.avg(miss * miss).alias("MSE"),
        F.var_pop(actual).alias("_spread"),
        (F.avg(share) * 100).alias("MAPE"),
        F.count_if(actual == 0).alias("n_zero_actual"),
    )
    r2 = F.when(F.col("_spread") > 0, 1 - F.col("MSE") / F.nullif("_spread", F.lit(0.0)))
    named = {"MAE": F.col("MAE"), "MSE": F.col("MSE"), "RMSE": F.sqrt("MSE"), "R2": r2, "MAPE": F.col("MAPE")}
    return agg.select(*keys, "n", *(significant(c).alias(k) for k, c in named.items()), "n_zero_actual")


def best_by(metrics: DataFrame, keys: list[str], metric: str, tie: str, lowest: bool = True) -> DataFrame:
    """Per ``keys``, the row with the lowest (or highest) metric; ties -> smallest ``tie``."""
    order = F.struct(F.col(metric) if lowest else -F.col(metric), F.col(tie))
    payload = F.struct(*[F.col(c) for c in metrics.columns if c not in keys])
    best = metrics.where(F.col(metric).isNotNull()).groupBy(*keys).agg(F.min_by(payload, order).alias("_b"))
    return best.select(*keys, "_b.*")
