"""The sales forecast on a CSV base (S3, P13, P19, C9-C13, M1-M7): DATA, PREVISAO, PREVISAO_REDE.

The base holds one row per day: DATA as dd-mm-yy, two values and the calendar
flags.  A fixed test period follows the training days.  Date parts are plain
(no special-date codes); each label has its own outlier bounds, feature list,
search space and refit metric.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.columns import outlier_class
from tillwise.operators import boosted
from tillwise.operators.outliers import choose_bounds, series_bounds
from tillwise.plans import retail
from tillwise.plans.abt import ABT_START, abt_daily
from tillwise.session import per_application
from tillwise.sources.sinks import read_csv_dated, scratch_dir, write_csv

TEST_FROM, LAST_DAY = "2001-06-01", "2001-06-30"

_EDGES = ["POS_SEXTA", "VESPERA_SEXTA"]
_WEEKEND = ["SEX", "SAB", "DOM"]
# Feature list, outlier method, scoring-time reset and refit metric per label.
CSV_LABELS: dict[str, dict] = {
    "VALOR_TOTAL": {
        "bounds": "tukey",
        "reset_test_outlier": False,
        "refit": "MAE",
        "features": retail._COMMON + ["BRIDGE", "VESPERA"] + retail._HOLIDAY_FEATURES
        + ["OUTLIER"] + _WEEKEND + ["SEMANA_PASCOA"] + _EDGES,
        "output": "PREVISAO",
    },
    "VLR_REDE": {
        "bounds": "quantile",
        "reset_test_outlier": True,
        "refit": "R2",
        "features": retail._COMMON + ["VESPERA", "BRIDGE"] + retail._HOLIDAY_FEATURES
        + ["DECORRIDO", "OUTLIER"] + _EDGES + _WEEKEND,
        "output": "PREVISAO_REDE",
    },
}
FLAGS = [c for c in retail.CARRIED if c != "PIX_CATEG"]
BASE_SCHEMA = T.StructType([T.StructField("DATA", T.StringType())]
                           + [T.StructField(c, T.DoubleType()) for c in CSV_LABELS]
                           + [T.StructField(c, T.IntegerType()) for c in FLAGS])


#: Search space per label: only the total is also tried with the Tweedie objective.
GRIDS = {"VALOR_TOTAL": boosted.FULL_GRID, "VLR_REDE": boosted.SQUARED_GRID}


def read_base(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_dated(spark, path, BASE_SCHEMA, "DATA")


def split_fixed(df: DataFrame, test_from: str, last: str, date_col: str = "DATA") -> DataFrame:
    """P13 with fixed dates: days from ``test_from`` to ``last`` are the test, earlier ones the training."""
    d = F.col(date_col)
    kept = df.where(d <= F.to_date(F.lit(last)))
    return kept.withColumn("split", F.when(d < F.to_date(F.lit(test_from)), F.lit("train")).otherwise(F.lit("test")))


def model_rows(base: DataFrame, test_from: str, last: str, reference_mode: bool = False) -> DataFrame:
    """(series, DATA, y, split, fold, features) of both labels.

    Test rows have outlier class 0: their actuals are not used.  With ``reference_mode``
    they get the class of their own actuals, except for labels marked ``reset_test_outlier``.
    """
    values = F.inline(F.array(*[F.struct(F.lit(c).alias("series"), F.col(c).alias("y")) for c in CSV_LABELS]))
    rows = split_fixed(base.select("DATA", *FLAGS, values), test_from, last)
    spec = {k: F.create_map(*[F.lit(x) for c, v in CSV_LABELS.items() for x in (c, v[k])])[F.col("series")]
            for k in ("bounds", "reset_test_outlier")}
    bounds = series_bounds(rows.where(F.col("split") == "train"), ["series"], "y")
    lower, upper = choose_bounds(spec["bounds"])
    reset = (F.col("split") == "test") & (spec["reset_test_outlier"] | F.lit(not reference_mode))
    kind = F.when(reset, F.lit(0)).otherwise(outlier_class(F.col("y"), lower, upper)).cast("int")
    marked = rows.join(bounds, "series").withColumn("OUTLIER", kind).drop(*[c for c in bounds.columns if c != "series"])
    dated = retail.add_date_parts(marked, ["series", "split"], special=False)
    train = retail.add_folds(dated.where(F.col("split") == "train"))
    return train.unionByName(dated.where(F.col("split") == "test").withColumn("fold", F.lit(-1)))


def forecast_csv(spark: SparkSession, base: DataFrame, test_from: str, last: str,
                 grids: dict[str, list[dict]] | None = None) -> DataFrame:
    """DATA, PREVISAO, PREVISAO_REDE of the test days, each from its label's best parameter set."""
    from tillwise.plans.models import train_labels

    preds, _, _ = train_labels(spark, model_rows(base, test_from, last), CSV_LABELS, grids or GRIDS)
    one = [F.max(F.when(F.col("series") == label, F.col("PREVISAO"))).alias(spec["output"]) for label, spec in CSV_LABELS.items()]
    return preds.groupBy("DATA").agg(*one)


# --------------------------------------------------------------------------- registered jobs
def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV base of the test data: the feature table written as CSV (VLR_REDE: its SMART value)."""
    def build() -> str:
        abt = abt_daily(spark, sf_dir, as_of=retail.FORECAST_AS_OF, start=ABT_START)
        path = scratch_dir(spark, "csv-base")
        write_csv(abt.select(F.date_format("DATA", "dd-MM-yy").alias("DATA"), "VALOR_TOTAL",
                             F.col("VALOR_SMART_TOTAL").alias("VLR_REDE"), *FLAGS), path)
        return path

    return read_base(spark, per_application(spark, ("csv_base", sf_dir), build))


def csv_forecast_inputs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split, fold, outlier class and elapsed days of both labels."""
    rows = model_rows(_base(spark, sf_dir), TEST_FROM, LAST_DAY)
    return rows.select("series", "DATA", "y", "split", "fold", "OUTLIER", "DECORRIDO")


def rede_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature list of VLR_REDE in the scoring mode of the original."""
    rows = model_rows(_base(spark, sf_dir), TEST_FROM, LAST_DAY, reference_mode=True)
    return rows.where(F.col("series") == "VLR_REDE").select("DATA", "split", *CSV_LABELS["VLR_REDE"]["features"])


def csv_forecast_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both models on the CSV base: one row per test day."""
    return per_application(spark, ("csv_forecast", sf_dir),
                           lambda: forecast_csv(spark, _base(spark, sf_dir), TEST_FROM, LAST_DAY))
