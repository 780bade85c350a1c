"""Sinks and file sources: managed table overwrite (S9), CSV out/in (S11, S3), run log."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.session import scratch_path


def overwrite_table(df: DataFrame, name: str) -> None:
    """Replace a managed table."""
    df.write.mode("overwrite").saveAsTable(name)


def work_table(spark: SparkSession, name: str) -> str:
    """Full name of a table in the database ``tillwise_work``, which lies in the shared folder where it is first made."""
    if not spark.catalog.databaseExists("tillwise_work"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS tillwise_work LOCATION '{scratch_dir(spark, 'tables')}'")
    return f"tillwise_work.{name}"


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV, one directory of part files (no driver-side pandas)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def parse_dd_mm_yy(c: Column, pivot: int = 69) -> Column:
    """'dd-mm-yy' -> date with the two-digit-year rule of C/Python ``%y``:
    ``pivot``..99 -> 19xx, 00..pivot-1 -> 20xx (Spark's own ``yy`` maps all to 20xx).
    Malformed strings give NULL instead of failing the job."""
    parts = F.split(c, "-")
    dd, mm, yy = (parts.getItem(i).try_cast("int") for i in range(3))
    year = F.when(yy >= pivot, yy + 1900).otherwise(yy + 2000)
    ok = (F.size(parts) == 3) & (F.length(parts.getItem(2)) == 2)
    iso = F.format_string("%04d-%02d-%02d", year, mm, dd)
    return F.when(ok, F.try_to_date(iso, "yyyy-MM-dd"))


def read_csv_dated(spark: SparkSession, path: str, schema: T.StructType, date_col: str,
                   sep: str = ",") -> DataFrame:
    """S3: CSV with a declared schema (date column read as text), date parsed as dd-mm-yy."""
    raw = spark.read.schema(schema).option("header", True).option("sep", sep).option("mode", "FAILFAST").csv(path)
    return raw.withColumn(date_col, parse_dd_mm_yy(F.col(date_col)))


def scratch_dir(spark: SparkSession, prefix: str) -> str:
    """A fresh directory under the shared checkpoint folder."""
    return scratch_path(spark, f"{prefix}-{uuid.uuid4().hex[:12]}")


def saved(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` written in the shared folder and read again: later steps survive lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    out = df.sparkSession.read.schema(T.StructType([f for f in df.schema if f.name not in by] + [f for f in df.schema if f.name in by])).parquet(path)
    out._saved = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a ``saved`` frame that no later step reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._saved)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("series", T.StringType()),
    T.StructField("as_of", T.DateType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
])


def run_log_rows(best: DataFrame, as_of: str, param_cols: list[str], metric_cols: list[str],
                 series_col: str = "series") -> DataFrame:
    """One log row per series run: params and (positive) metrics as maps."""
    params = F.map_filter(F.create_map(*[x for c in param_cols for x in (F.lit(c), F.col(c).cast("string"))]),
                          lambda k, v: v.isNotNull() & (v != ""))  # parameters a model does not use
    metrics = F.create_map(*[x for c in metric_cols for x in (F.lit(c), F.col(c).cast("double"))])
    run_id = F.sha2(F.concat_ws("|", F.col(series_col), F.lit(as_of), F.to_json(params)), 256).substr(1, 16)
    return best.select(run_id.alias("run_id"), F.col(series_col).alias("series"),
                       F.to_date(F.lit(as_of)).alias("as_of"), params.alias("params"), metrics.alias("metrics"))


def append_run_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)
