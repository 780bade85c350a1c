"""Metrics (A11, A12), best-by (A15), threshold sweep (A13, A14) against brute force."""

import math

import numpy as np
import pytest

from tillwise.operators.metrics import best_by, regression_metrics
from tillwise.operators.threshold import best_threshold, threshold_sweep


def test_regression_metrics_and_zero_actual(spark):
    rows = [("s", 100.0, 90.0), ("s", 200.0, -210.0), ("s", 0.0, 5.0), ("s", 50.0, 50.0)]
    df = spark.createDataFrame(rows, "series string, y double, yhat double")
    m = regression_metrics(df, ["series"]).first()
    y = np.array([100.0, 200.0, 0.0, 50.0])
    f = np.array([90.0, -210.0, 5.0, 50.0])
    assert m.n == 4 and m.n_zero_actual == 1
    assert math.isclose(m.MAE, np.mean(np.abs(y - f)))
    assert math.isclose(m.MSE, np.mean((y - f) ** 2))
    assert math.isclose(m.R2, 1 - np.sum((y - f) ** 2) / np.sum((y - y.mean()) ** 2))
    nz = y != 0
    assert math.isclose(m.MAPE, np.mean(np.abs((y[nz] - np.abs(f[nz])) / y[nz])) * 100)


def test_best_by_ties_take_smallest_id(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 0, 5.0), ("a", 2, 7.0)], "k string, pid int, MAPE double")
    assert best_by(df, ["k"], "MAPE", "pid").first().pid == 0


def _brute(conf, truth):
    out = []
    for i in range(1, 100):
        t = i / 100
        pred = [1 if c >= t else 0 for c in conf]
        res = {}
        for cls in (0, 1):
            tp = sum(1 for p, y in zip(pred, truth) if p == cls and y == cls)
            fp = sum(1 for p, y in zip(pred, truth) if p == cls and y != cls)
            fn = sum(1 for p, y in zip(pred, truth) if p != cls and y == cls)
            pr = tp / (tp + fp) if tp + fp else 0.0
            rc = tp / (tp + fn) if tp + fn else 0.0
            f1 = 2 * pr * rc / (pr + rc) if pr + rc else 0.0
            res[cls] = (pr, rc, f1, sum(1 for y in truth if y == cls))
        n = len(truth)
        out.append((t, *[sum(res[c][k] * res[c][3] for c in (0, 1)) / n for k in range(3)]))
    return out


@pytest.mark.parametrize("case", ["mixed", "all_correct", "all_wrong"])
def test_sweep_matches_brute_force(spark, case):
    conf = [0.07, 0.29, 0.5, 0.005, 0.99, 0.999, 0.3, 0.07, 1.0, 0.01]
    truth = {"mixed": [1, 0, 1, 0, 1, 1, 0, 1, 0, 1], "all_correct": [1] * 10, "all_wrong": [0] * 10}[case]
    df = spark.createDataFrame(list(zip(conf, truth)), "conf double, truth int")
    got = sorted(tuple(r) for r in threshold_sweep(df).collect())
    exp = _brute(conf, truth)
    assert len(got) == 99
    for g, e in zip(got, exp):
        assert g[0] == e[0]
        assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(g[1:], e[1:]))
    best = best_threshold(threshold_sweep(df)).first()
    top = max(e[3] for e in exp)
    assert best.threshold == min(e[0] for e in exp if e[3] == top)
