"""Every registered query with an oracle must match DuckDB on sf0.01 (rows, columns, values)."""

import pytest

import __spark_entry__ as entry
from scripts.check_oracle import duck, rows
from tests.conftest import SF01

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    s = entry.queries()[name](spark, SF01).toPandas()
    d = con.sql(ORACLES[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert rows(s, digits=None) == rows(d, digits=None)  # exact: floats are bit-identical


def test_every_query_has_a_builder():
    qs = entry.queries()
    assert set(ORACLES) <= set(qs)
    assert len(qs) >= 40


def test_entry_smoke(spark):
    from tillwise.operators.calendar_features import CALENDAR_FEATURE_COLUMNS
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == CALENDAR_FEATURE_COLUMNS + ["PIX_CATEG", "VLR_SMART_PIX", "VLR_TOTAL_PIX",
                                                     "VALOR_TOTAL", "VALOR_SMART_TOTAL"]
