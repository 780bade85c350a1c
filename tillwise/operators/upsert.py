"""MERGE-style upsert without a table format.

``merge_frames``: target rows whose key is not in the source are kept, every
source row is taken (matched -> update all, unmatched -> insert all).  It is
a left-anti join plus a union: one shuffle on the key, no driver work.  A key
that occurs twice in the source fails the query that reads the result.

``upsert_partitions`` merges into a Parquet table that is partitioned by the
months of a date column; only the months that the source touches are read and
written again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.sources.sinks import scratch_dir

DUPLICATE_KEY = "source has duplicate merge keys"


def unique_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """``source``; reading it fails if a key occurs twice (MERGE cannot pick a row).

    Keys with a null match nothing, so they may repeat.  The count is a window on the
    key, the partitioning that the merge's join needs anyway.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    twice = F.col("_n_of_key") > 1
    once = F.when(whole & twice, F.raise_error(F.lit(DUPLICATE_KEY)).cast("boolean")).otherwise(F.lit(True))
    return source.withColumn("_n_of_key", n).where(once).drop("_n_of_key")


def merge_frames(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows not matched by key, plus all source rows (columns by name)."""
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(unique_keys(source, keys).select(*target.columns))


def upsert_partitions(source: DataFrame, path: str, keys: list[str], date_col: str) -> None:
    """MERGE ``source`` into the Parquet table at ``path``, partitioned by ``month`` of ``date_col``.

    ``date_col`` is one of the keys, so that a row stays in its month.  The merged months are
    written to the shared scratch folder first (they cannot be read and replaced at once) and
    then replace the table's; other months are not touched.  The first write makes the table.
    One writer at a time: Parquet files know no transactions.
    """
    if date_col not in keys:
        raise ValueError(f"{date_col} must be one of the merge keys {keys}")
    spark = source.sparkSession
    month = F.date_format(date_col, "yyyy-MM")
    scratch = scratch_dir(spark, "upsert")
    source.write.parquet(f"{scratch}/source")
    source = spark.read.parquet(f"{scratch}/source")
    try:
        target = spark.read.option("basePath", path).parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        merged = unique_keys(source, keys).withColumn("month", month)
    else:
        touched = source.select(month.alias("month")).distinct()
        # a month is matched by its text: the scan's own type for ``month`` is a date or a string
        own = target.withColumn("month", month).join(touched, "month", "left_semi")
        merged = merge_frames(own, source.withColumn("month", month), keys)
    merged.write.parquet(f"{scratch}/merged")
    done = spark.read.parquet(f"{scratch}/merged")
    done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
