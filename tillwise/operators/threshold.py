"""Confidence threshold sweep (A13) and best threshold (A14) in one pass.

For thresholds t = 0.01 ... 0.99, predict 1 when ``conf >= t`` and score the
0/1 truth with support-weighted precision, recall and F1 over classes {0, 1}
(a class with no predictions or no members scores 0, as zero_division=0).

Instead of 99 passes, each row is mapped to its bucket = how many thresholds
it passes (exact double comparison against the same ``i / 100`` values), the
data is reduced to (bucket, truth) counts - at most 200 rows, whatever the
input size - and suffix sums over the buckets give every threshold's
confusion matrix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

N_THRESHOLDS = 99


def thresholds() -> Column:
    return F.transform(F.sequence(F.lit(1), F.lit(N_THRESHOLDS)), lambda i: i.cast("double") / 100)


def _safe_ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def threshold_sweep(scored: DataFrame, conf: str = "conf", truth: str = "truth") -> DataFrame:
    """(threshold, precision, recall, f1) for the 99 thresholds."""
    c = F.col(conf).cast("double")
    bucket = F.size(F.filter(thresholds(), lambda t: c >= t))
    counts = (scored.groupBy(bucket.alias("bucket"))
              .agg(F.sum((F.col(truth) == 1).cast("long")).alias("n1"),
                   F.sum((F.col(truth) != 1).cast("long")).alias("n0")))
    spark = scored.sparkSession
    grid = spark.range(0, N_THRESHOLDS + 1).select(F.col("id").cast("int").alias("bucket"))
    full = grid.join(F.broadcast(counts), "bucket", "left").na.fill(0, ["n1", "n0"])
    # bounded window: 100 rows, one per bucket
    suffix = Window.orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(F.lit(1))
    cum = full.select(
        "bucket",
        F.sum("n1").over(suffix).alias("tp1"),
        F.sum("n0").over(suffix).alias("fp1"),
        F.sum("n1").over(every).alias("pos"),
        F.sum("n0").over(every).alias("neg"),
    ).where(F.col("bucket") >= 1)
    tp1, fp1, pos, neg = F.col("tp1"), F.col("fp1"), F.col("pos"), F.col("neg")
    fn1, tn = pos - tp1, neg - fp1
    p1, r1 = _safe_ratio(tp1, tp1 + fp1), _safe_ratio(tp1, pos)
    p0, r0 = _safe_ratio(tn, tn + fn1), _safe_ratio(tn, neg)
    total = (pos + neg).cast("double")

    def weighted(m1: Column, m0: Column) -> Column:
        return F.when(total > 0, (pos.cast("double") * m1 + neg.cast("double") * m0) / total).otherwise(0.0)

    return cum.select(
        (F.col("bucket").cast("double") / 100).alias("threshold"),
        weighted(p1, p0).alias("precision"),
        weighted(r1, r0).alias("recall"),
        weighted(_f1(p1, r1), _f1(p0, r0)).alias("f1"),
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The row with the highest F1; the lowest threshold wins ties."""
    row = F.struct("threshold", "precision", "recall", "f1")
    return sweep.agg(F.min_by(row, F.struct(-F.col("f1"), F.col("threshold"))).alias("b")).select("b.*")
