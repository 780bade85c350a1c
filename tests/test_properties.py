"""Property tests: Spark column logic against plain-Python twins on generated inputs."""

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwise.functions.text import STOP_WORDS, terms
from tillwise.operators import flyer as FL
from tillwise.operators.threshold import threshold_sweep
from tests.test_flyer import py_wrap
from tests.test_metrics_and_sweep import _brute

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
PIECES = st.sampled_from(list("abcdeéçãõ XYZ12_-/.,;!?()&'\"") + ["de", "a", "o ", "  ", "uma"])
TEXTS = st.lists(PIECES, max_size=40).map("".join)


def py_terms(text):
    toks = [w for w in re.findall(r"(?u)\b\w\w+\b", text.lower()) if w not in STOP_WORDS]
    return toks + [f"{a} {b}" for a, b in zip(toks, toks[1:])]


@SETTINGS
@given(st.lists(TEXTS, min_size=1, max_size=6))
def test_terms_property(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = {r.id: list(r.t) for r in df.select("id", terms(F.col("text")).alias("t")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == py_terms(t)


@SETTINGS
@given(st.lists(st.text(alphabet=st.sampled_from(list("abc XYZ-")), max_size=80), min_size=1, max_size=5),
       st.integers(min_value=3, max_value=25))
def test_wrap_property(spark, texts, width):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [list(r.l) for r in df.select(FL.wrap_caption(F.col("t"), width=width).alias("l")).collect()]
    assert got == [py_wrap(t, width=width) for t in texts]


@SETTINGS
@given(st.lists(st.tuples(st.integers(min_value=0, max_value=1000).map(lambda k: k / 1000),
                          st.integers(min_value=0, max_value=1)), min_size=1, max_size=40))
def test_sweep_property(spark, rows):
    df = spark.createDataFrame(rows, "conf double, truth int")
    got = sorted(tuple(r) for r in threshold_sweep(df).collect())
    exp = _brute([c for c, _ in rows], [y for _, y in rows])
    for g, e in zip(got, exp):
        assert g[0] == e[0] and all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(g[1:], e[1:]))
