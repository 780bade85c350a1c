"""Outlier bounds per series (A8 quantile 5/95 %, A9 Tukey fences) and classes.

Exact percentiles (linear interpolation, as pandas ``quantile``) per series
group.  ``percentile`` buffers one group's values, which is fine for daily
series (a group is at most the number of days); ``approx=True`` switches to
``percentile_approx`` for very long series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBS = [0.05, 0.25, 0.75, 0.95]


def series_bounds(df: DataFrame, keys: list[str], value: str, approx: bool = False) -> DataFrame:
    """keys -> p05, q1, q3, p95, quantile fences (q_li, q_ls) and Tukey fences (t_li, t_ls)."""
    v = F.col(value).cast("double")
    if approx:
        p = F.percentile_approx(v, PROBS, 100000)
    else:
        p = F.percentile(v, F.array(*[F.lit(x) for x in PROBS]))
    agg = df.groupBy(*keys).agg(p.alias("_p"))
    p05, q1, q3, p95 = (F.col("_p")[i] for i in range(4))
    iqr = q3 - q1
    return agg.select(
        *keys,
        p05.alias("p05"), q1.alias("q1"), q3.alias("q3"), p95.alias("p95"),
        p05.alias("q_li"), p95.alias("q_ls"),
        (q1 - 1.5 * iqr).alias("t_li"), (q3 + 1.5 * iqr).alias("t_ls"),
    )


def choose_bounds(method: Column) -> tuple[Column, Column]:
    """(lower, upper) fence columns for a method column valued 'quantile' / 'tukey'."""
    lower = F.when(method == "quantile", F.col("q_li")).when(method == "tukey", F.col("t_li"))
    upper = F.when(method == "quantile", F.col("q_ls")).when(method == "tukey", F.col("t_ls"))
    return lower, upper
