import pytest
from pyspark.sql import types as T

from tests.conftest import SF001

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) pairs."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOC).repartition(3)

    return make


@pytest.fixture
def folder(spark, tmp_path):
    """Write tables as ``name.parquet`` into a folder, as queries read them."""
    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


@pytest.fixture(scope="session")
def corpus(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]


#: Null, empty and blank texts, ties, repeated rows, a very long text and a very long word.
ODD = [(1, None), (2, ""), (3, " \t\n\r\x0b\x0c "), (4, "Hello  hello\nHELLO"), (4, "Hello  hello\nHELLO"), (5, "Hello  hello\nHELLO"),
       (None, "no id here"), (6, "word " * 30_000), (7, "x" * 50_000), (8, "ÄÖ é 漢字   \U0001f600 | ### 1.2.3.4"), (9, "a" * 900 + "é" * 300 + "a" * 900)]
