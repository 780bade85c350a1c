"""Scans of the supplied parquet tables (S1, S5) with declared schemas.

Each table is read with an explicit schema, so a changed file fails loudly
instead of silently changing types, and Catalyst still prunes columns and
pushes filters into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_L, _I, _D, _S, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I),
                        ("c_acctbal", _D), ("c_mktsegment", _S)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "part": _schema(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S),
                    ("p_size", _I), ("p_retailprice", _D)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S),
                      ("o_totalprice", _D), ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L),
                        ("l_linenumber", _I), ("l_quantity", _D), ("l_extendedprice", _D),
                        ("l_discount", _D), ("l_tax", _D), ("l_returnflag", _S),
                        ("l_linestatus", _S), ("l_shipdate", _TS)),
    "events": _schema(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S),
                      ("value", _D), ("props", _S)),
    "documents": _schema(("doc_id", _L), ("text", _S), ("lang", _S), ("source", _S), ("n_chars", _L)),
    "labels": _schema(("doc_id", _L), ("quality", _I), ("toxic", _I)),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(path)


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).lineitem`` is a DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan over at least the default parallelism before CPU-heavy per-row work.

    Large tables made of many files / row groups already scan in thousands of
    splits and are returned unchanged (no extra shuffle); a table stored as one
    row group would otherwise be processed by a single task.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # no RDD view (e.g. Spark Connect): leave the scan as planned
        return df
    return df if current >= target else df.repartition(target)


def read_holiday_table(spark: SparkSession, name: str, date_col: str = "DATA",
                       name_col: str = "holiday") -> DataFrame:
    """A catalog holiday table as ``(ds, holiday)``.  It stays a DataFrame (joined or
    broadcast where used), never collected to the driver."""
    from pyspark.sql import functions as F

    return spark.table(name).select(F.col(date_col).cast("date").alias("ds"), F.col(name_col).alias("holiday"))


# Column names of the original source tables, mapped to this
# package's names (transactions, client dimension, calendar dimension).
TRANSACTION_COLUMNS = {"CODLOJASITEF": "store", "NUMANOMES": "anomes", "DATA_TRN": "data_trn",
                       "TIPO_TRANSACAO": "tipo", "VALOR": "valor"}
CLIENT_COLUMNS = {"codcliend": "codcliend", "DESUNDNGCCLI": "segment"}
BEST_SELLER_COLUMNS = {"CODCLI": "codcli", "CODMERSRR": "codmersrr"}
CATALOGUE_COLUMNS = {"IDPRODUTO": "idproduto", "DESCPRODUTO": "descproduto", "URL_IMAGEM": "url_imagem"}
CALENDAR_COLUMNS = {"Data": "data", "Dia": "dia", "numero_do_ano_mes": "ano_mes", "Semanas_do_Ano": "semana_ano",
                    "numero_do_dia_da_semana": "dow", "flag_primeiro_dia_do_mes": "primeiro_dia",
                    "flag_ultimo_dia_do_mes": "ultimo_dia", "numero_da_semana_no_mes": "semana_mes"}


def _renamed(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    from pyspark.sql import functions as F

    lower = {c.lower(): c for c in df.columns}
    return df.select(*[F.col(lower[src.lower()]).alias(dst) for src, dst in mapping.items()])


def read_transactions_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog transaction table under its original column names."""
    return _renamed(spark.table(name), TRANSACTION_COLUMNS)


def read_client_table(spark: SparkSession, name: str) -> DataFrame:
    return _renamed(spark.table(name), CLIENT_COLUMNS)


def read_calendar_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog calendar dimension (dow 1 = Sunday) under its original column names."""
    from pyspark.sql import functions as F

    df = _renamed(spark.table(name), CALENDAR_COLUMNS)
    return df.withColumn("data", F.col("data").cast("date"))


def read_best_sellers_table(spark: SparkSession, name: str, rank_col: str) -> DataFrame:
    """Best-seller list (customer, product) with its explicit ranking column as ``rank``
    (a table has no row order; pass ``order=[F.col("rank")]`` to the flyer feed)."""
    return _renamed(spark.table(name), {**BEST_SELLER_COLUMNS, rank_col: "rank"})


def read_catalogue_table(spark: SparkSession, name: str) -> DataFrame:
    return _renamed(spark.table(name), CATALOGUE_COLUMNS)
