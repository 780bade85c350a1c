"""Upsert (S10), CSV dates (S3), additive model planted signal (M8), label registry."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillwise.operators import additive
from tillwise.operators.upsert import DUPLICATE_KEY, merge_frames, upsert_partitions
from tillwise.sources.sinks import parse_dd_mm_yy, scratch_dir


def test_merge_frames(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    src = spark.createDataFrame([(2, "B"), (4, "D")], "k int, v string")
    assert sorted(tuple(r) for r in merge_frames(tgt, src, ["k"]).collect()) == [(1, "a"), (2, "B"), (3, "c"), (4, "D")]
    with pytest.raises(Exception, match=DUPLICATE_KEY):
        merge_frames(tgt, spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"), ["k"]).collect()
    nulls = spark.createDataFrame([(None, "x"), (None, "y")], "k int, v string")
    assert merge_frames(tgt, nulls, ["k"]).count() == 5  # null keys match nothing


def test_upsert_partitions(spark):
    path = scratch_dir(spark, "months")

    def frame(rows):
        return spark.createDataFrame([(dt.date(*d), v) for d, v in rows], "data date, v double")

    upsert_partitions(frame([((2024, 1, 5), 1.0), ((2024, 1, 9), 2.0), ((2024, 2, 1), 3.0)]), path, ["data"], "data")
    untouched = set(spark.read.parquet(f"{path}/month=2024-02").inputFiles())
    upsert_partitions(frame([((2024, 1, 9), 20.0), ((2024, 3, 1), 4.0)]), path, ["data"], "data")
    got = spark.read.parquet(path)
    assert sorted((r.data.isoformat(), r.v) for r in got.collect()) == [
        ("2024-01-05", 1.0), ("2024-01-09", 20.0), ("2024-02-01", 3.0), ("2024-03-01", 4.0)]
    assert set(spark.read.parquet(f"{path}/month=2024-02").inputFiles()) == untouched
    with pytest.raises(Exception, match=DUPLICATE_KEY):
        upsert_partitions(frame([((2024, 1, 9), 1.0), ((2024, 1, 9), 2.0)]), path, ["data"], "data")
    assert spark.read.parquet(path).count() == 4  # a failed merge leaves the table as it was
    with pytest.raises(ValueError):
        upsert_partitions(frame([]), path, ["v"], "data")


def test_two_digit_years(spark):
    df = spark.createDataFrame([("01-02-68",), ("01-02-69",), ("31-12-99",), ("bad",), ("31-02-01",)], "s string")
    got = [r.d for r in df.select(parse_dd_mm_yy(F.col("s")).alias("d")).collect()]
    assert got == [dt.date(2068, 2, 1), dt.date(1969, 2, 1), dt.date(1999, 12, 31), None, None]


def test_additive_recovers_planted_signal():
    days = pd.date_range("2019-01-01", "2021-12-31", freq="D")
    t = np.arange(len(days))
    weekly = np.array([0, 5, 5, 5, 5, 10, -20])[days.dayofweek]
    y = 100 + 0.05 * t + weekly + 8 * np.sin(2 * np.pi * t / 365.25)
    hol = [np.array(["X"]) if d.month == 12 and d.day == 25 else None for d in days]
    y = y + np.array([30.0 if h is not None else 0.0 for h in hol])
    m = additive.AdditiveModel(0.05, 0.5, 25).fit(pd.Series(days), pd.Series(y), hol)
    future = pd.date_range("2022-01-01", periods=30, freq="D")
    truth = 100 + 0.05 * np.arange(len(days), len(days) + 30) + np.array([0, 5, 5, 5, 5, 10, -20])[future.dayofweek] \
        + 8 * np.sin(2 * np.pi * np.arange(len(days), len(days) + 30) / 365.25)
    pred = m.predict(pd.Series(future), [None] * 30)["yhat"].to_numpy()
    assert np.mean(np.abs(pred - truth)) < 2.0
    # seasonal-naive baseline is beaten
    assert np.mean(np.abs(pred - truth)) < np.mean(np.abs(y[-7:].repeat(5)[:30] - truth))


def test_additive_constant_and_short_series():
    days = pd.Series(pd.date_range("2024-01-01", periods=5, freq="D"))
    m = additive.AdditiveModel(0.05, 0.1, 100).fit(days, pd.Series([7.0] * 5), [None] * 5)
    pred = m.predict(days, [None] * 5)["yhat"].to_numpy()
    assert np.allclose(pred, 7.0, atol=1e-3)


def test_one_design_serves_all_prior_scales():
    days = pd.Series(pd.date_range("2021-01-01", periods=900, freq="D"))
    rng = np.random.default_rng(5)
    y = pd.Series(50 + rng.normal(size=900) + 5 * (days.dt.dayofweek == 4))
    hol = [np.array(["X"]) if d.day == 25 else None for d in days]
    shared = additive.AdditiveModel(0.3, 0.3, 100).prepare(days, y, hol)
    for p in additive.GRID[::3]:
        scales = p["changepoint_prior_scale"], p["holidays_prior_scale"]
        alone = additive.AdditiveModel(*scales, 100).fit(days, y, hol)
        assert np.array_equal(shared.solve(*scales).beta, alone.beta) and shared.sigma == alone.sigma


def two_breaks(n, seed=0, noise=0.5):
    """Days with a slope that changes twice, a weekly wave and noise."""
    rng = np.random.default_rng(seed)
    t = np.arange(n, dtype=float)
    trend = 100 + 0.05 * t + 0.3 * np.maximum(0, t - n * 0.3) - 0.4 * np.maximum(0, t - n * 0.6)
    return pd.Series(pd.date_range("2021-01-01", periods=n, freq="D")), pd.Series(trend + 3 * np.sin(2 * np.pi * t / 7) + noise * rng.normal(size=n))


def test_laplace_slopes_are_sparse():
    days, y = two_breaks(600)
    m = additive.AdditiveModel(0.05, 0.1, 100).fit(days, y, [None] * 600)
    slopes = np.abs(m.beta[2:2 + len(m.changepoints)])
    gauss = np.abs(np.linalg.solve(m.gram + np.diag(m._penalty(np.full(100, m.cps))), m.moments)[2:102])
    many = lambda v: int((v > 0.05 * v.max()).sum())
    assert many(slopes) < 30 < 60 < many(gauss)
    near = np.min(np.abs(m.changepoints[:, None] - np.array([0.3, 0.6])), axis=1) < 0.05
    assert slopes[near].sum() > 0.9 * slopes.sum()
    # the reweighted steps reach a point that no slope can leave with profit
    def loss(beta):
        fit = np.sum((m.yv / m.y_scale - m.X @ beta) ** 2) / (2 * additive.NOISE_VAR)
        return fit + np.sum(np.abs(beta[2:2 + len(m.changepoints)])) / m.cps
    for j in np.r_[2:2 + len(m.changepoints):9]:
        for step in (-0.02, 0.02):
            moved = m.beta.copy()
            moved[j] += step
            assert loss(moved) > loss(m.beta) - 1e-3


def test_band_widens_and_covers():
    """Series drawn as the model assumes: trend changes at its changepoints and at the same rate after them."""
    rng = np.random.default_rng(8)
    n, ahead, n_cp, series = 400, 30, 10, 100
    days = pd.Series(pd.date_range("2021-01-01", periods=n + ahead, freq="D"))
    at = np.linspace(0, int(n * 0.8) - 1, n_cp + 1).round()[1:]
    t = np.arange(n + ahead, dtype=float)
    inside = total = 0
    for _ in range(series):
        later = n - 1 + ahead * rng.random(rng.poisson(n_cp * ahead / (n - 1)))
        changes = np.r_[at, later]
        trend = 0.5 * t + np.maximum(0, t[:, None] - changes) @ rng.laplace(0, 6, len(changes))
        y = 1000 + trend - trend.min() + 20 * rng.normal(size=n + ahead)
        m = additive.AdditiveModel(2, 0.1, n_cp).fit(days[:n], pd.Series(y[:n]), [None] * n)
        pred = m.predict(days[n:].reset_index(drop=True), [None] * ahead)
        width = (pred.yhat_upper - pred.yhat_lower).to_numpy()
        assert width[-5:].mean() > 1.1 * width[:5].mean()
        inside += int(((y[n:] >= pred.yhat_lower) & (y[n:] <= pred.yhat_upper)).sum())
        total += ahead
    assert 0.75 <= inside / total <= 0.85, inside / total


def test_tracking_equals_refits_from_scratch(spark):
    days, y = two_breaks(200)
    rows = [("s", d.date(), float(v)) for d, v in zip(days, y, strict=True)] + [("short", days[195].date(), 1.0)]
    rows = [r for r in rows if r[1] != dt.date(2021, 7, 5)]  # a day without a value
    series = spark.createDataFrame(rows, "series string, ds date, y double")
    holidays = spark.createDataFrame([(dt.date(2021, 2, 1), "X"), (dt.date(2021, 7, 4), "X")], "ds date, holiday string")
    best = spark.createDataFrame([("s", 0.1, 0.2, 20), ("short", 0.1, 0.2, 20)], "series string, changepoint_prior_scale double, holidays_prior_scale double, n_changepoints int")
    got = sorted(additive.track(series, best, holidays, "2021-07-01", "2021-07-10").collect(), key=lambda r: r.data)
    assert len(got) == 10 and {r.series for r in got} == {"s"}
    names = {dt.date(2021, 2, 1): np.array(["X"]), dt.date(2021, 7, 4): np.array(["X"])}
    own = [r for r in rows if r[0] == "s"]
    base = [r for r in own if r[1] < dt.date(2021, 7, 1)]
    for r in got:
        m = additive.AdditiveModel(0.1, 0.2, 20).prepare(pd.Series([x[1] for x in base]), pd.Series([x[2] for x in base]), [names.get(x[1]) for x in base])
        seen = [x for x in own if x[1] < r.data]
        m.X = m._design(m._days(pd.Series([x[1] for x in seen])), [names.get(x[1]) for x in seen])
        m.yv = np.array([x[2] for x in seen])
        m.gram, m.moments = m.X.T @ m.X, m.X.T @ (m.yv / m.y_scale)
        want = m.solve(0.1, 0.2).point(pd.Series([r.data]), [names.get(r.data)])[0]
        assert np.isclose(r.previsao_ajustada, want, rtol=1e-8)
        assert (r.real is None or np.isnan(r.real)) == (r.data == dt.date(2021, 7, 5))
    assert np.isclose(got[0].previsao_inicial, got[0].previsao_ajustada, rtol=1e-12)


def test_csv_forecast(spark):
    from tillwise.plans import csv_forecast as CF
    days = pd.date_range("2000-01-01", "2001-06-30", freq="D")
    rows = [(d.strftime("%d-%m-%y"), 1000.0 if str(d.date()) == "2001-06-15" else 100.0 + 10 * d.dayofweek, 10.0 + d.dayofweek, *[0] * len(CF.FLAGS)) for d in days]
    path = scratch_dir(spark, "rede")
    spark.createDataFrame(rows, CF.BASE_SCHEMA).write.option("header", True).csv(path)
    base = CF.read_base(spark, path)
    marked = CF.model_rows(base, "2001-06-01", "2001-06-30", reference_mode=True)
    tests = {(r.series, r.OUTLIER) for r in marked.where("split = 'test'").collect()}
    assert {o for s, o in tests if s == "VLR_REDE"} == {0}
    assert {o for s, o in tests if s == "VALOR_TOTAL"} == {0, 1}  # one planted test day lies over the fence
    got = CF.forecast_csv(spark, base, "2001-06-01", "2001-06-30", grids={c: [dict(objective="reg:squarederror", max_depth=3, learning_rate=0.3, n_estimators=n) for n in (5, 20)] for c in CF.CSV_LABELS})
    assert got.columns == ["DATA", "PREVISAO", "PREVISAO_REDE"] and got.count() == 30
    sat, mon = (got.where(F.col("DATA") == dt.date(2001, 6, d)).first() for d in (2, 4))
    assert sat.PREVISAO > mon.PREVISAO + 25


def test_label_registry():
    from tillwise.plans.retail import feature_columns, label_spec
    assert "PIX_CATEG" in feature_columns("VALOR_TOTAL") and "SEMANA_PASCOA" in feature_columns("VALOR_TOTAL")
    assert "SEMANA_PASCOA" not in feature_columns("VALOR_SMART_TOTAL")
    with pytest.raises(ValueError):
        label_spec("no such label")
    assert math.isclose(additive.BAND_Z, 1.2816)


def test_outlier_modes(spark):
    import datetime as dt

    from tillwise.plans.retail import add_outlier
    rows = [("VALOR_TOTAL", dt.date(2001, 1, d), "train", float(v)) for d, v in
            zip(range(2, 12), [10, 11, 12, 10, 11, 12, 10, 11, 500, 12])]
    rows += [("VALOR_TOTAL", dt.date(2001, 12, 24), "test", 900.0), ("VALOR_TOTAL", dt.date(2001, 12, 26), "test", 900.0),
             ("VALOR_SMART_TOTAL", dt.date(2001, 1, 2), "train", 1.0), ("VALOR_SMART_TOTAL", dt.date(2001, 1, 3), "train", 9.0),
             ("VALOR_SMART_TOTAL", dt.date(2001, 12, 24), "test", 50.0)]
    df = spark.createDataFrame(rows, "series string, DATA date, split string, y double")

    def get(mode):
        return {(r.series, r.DATA): r.OUTLIER for r in add_outlier(df, reference_mode=mode).collect()}
    default, ref = get(False), get(True)
    assert default[("VALOR_TOTAL", dt.date(2001, 1, 10))] == 1           # Tukey upper fence on train
    assert default[("VALOR_TOTAL", dt.date(2001, 12, 26))] == 0          # test: calendar only
    assert ref[("VALOR_TOTAL", dt.date(2001, 12, 26))] == 1              # original: test actuals used
    assert default[("VALOR_TOTAL", dt.date(2001, 12, 24))] == 1          # eve code
    assert ref[("VALOR_SMART_TOTAL", dt.date(2001, 12, 24))] == 0        # SMART test reset erases codes


def test_jobs_write_tables(spark, tmp_path):
    from tests.conftest import SF001
    from tillwise.plans.billing import write_billing_tables
    from tillwise.plans.models import run_cost_forecast_job
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tw_bill LOCATION '{tmp_path}/db'")
    write_billing_tables(spark, SF001, "tw_bill")
    assert spark.table("tw_bill.priced_usage").count() > 0
    assert spark.table("tw_bill.daily_cost").where("sku = 'ALL'").count() > 0
    base = str(tmp_path / "forecast")
    run_cost_forecast_job(spark, SF001, base)
    run_cost_forecast_job(spark, SF001, base)      # same rows merged again: no duplicates
    t = spark.read.parquet(base)
    assert t.count() == t.select("data").distinct().count() == 30


def test_outlier_class_edges(spark):
    from tillwise.functions.columns import outlier_class
    from tillwise.operators.outliers import series_bounds
    df = spark.createDataFrame([("c", 5.0)] * 4 + [("v", 1.0), ("v", 2.0), ("v", 3.0), ("v", None)],
                               "series string, y double")
    b = {r.series: r for r in series_bounds(df.na.drop(), ["series"], "y").collect()}
    assert b["c"].t_li == b["c"].t_ls == 5.0                     # constant series: zero IQR
    rows = spark.createDataFrame([(5.0,), (5.0001,), (None,)], "y double")
    got = [r.o for r in rows.select(outlier_class(F.col("y"), F.lit(5.0), F.lit(5.0)).alias("o")).collect()]
    assert got == [0, 1, 0]                                       # on the bound -> 0, NULL -> 0


def panel(spark, days=300):
    """Two series with a weekday effect, folds of 60 days, and 14 days without a fold."""
    first = dt.date(2000, 1, 1)
    rows = []
    for series, scale in (("a", 1.0), ("b", 3.0)):
        for d in range(days + 14):
            w = d % 7
            rows.append((series, first + dt.timedelta(d), scale * (100 + 80 * (w == 5) - 60 * (w == 6)), float(w == 5), float(w == 6), float(d % 3), d // 60 if d < days else -1))
    return spark.createDataFrame(rows, "series string, DATA date, y double, SEX double, SAB double, noise double, fold int")


def test_boosting_recovers_planted_weekday_effect(spark):
    from tillwise.operators import boosted
    features = {"a": ["SEX", "SAB", "noise"], "b": ["noise", "SAB", "SEX"]}
    grid = [dict(objective=o, max_depth=d, learning_rate=0.3, n_estimators=n) for o in (boosted.SQUARED, boosted.TWEEDIE) for d in (1, 3) for n in (2, 40)]
    rows = panel(spark)
    cv = boosted.cross_validate(rows, features, {"a": grid, "b": grid[:4]}, k=5)
    got = {(r.series, r.param_id, r.fold): r for r in cv.collect()}
    assert len(got) == 5 * (8 + 4) and all(r.n == 60 for r in got.values())
    for key, r in got.items():  # 40 trees get there, 2 do not
        assert (r.MAPE < 1.5) == (key[1] % 2 == 1), (key, r.MAPE)
    best = {r.series: r.param_id for r in boosted.choose(boosted.fold_means(cv, ["series"]), "MAE", ["series"]).collect()}
    fitted = boosted.refit(rows, features, {"a": grid, "b": grid[:4]}, best).collect()
    days = [r for r in fitted if r.feature is None]
    assert len(days) == 28 and all(abs(r.value - r.y) < 0.02 * r.y for r in days)
    shares = {(r.series, features[r.series][r.feature]): r.value for r in fitted if r.feature is not None}
    assert math.isclose(sum(shares.values()), 2.0) and shares["a", "noise"] < 0.01 and shares["b", "SEX"] > 0.2


def test_a_tree_takes_the_best_of_all_cuts():
    """The first cut of a tree against all cuts tried one by one, with missing values and more values than bins."""
    from tillwise.operators import boosted
    rng = np.random.default_rng(4)
    x = np.c_[rng.normal(size=700), rng.integers(0, 5, 700), rng.random(700) < 0.1].astype(float)
    x[::50, 1] = np.nan
    y = np.where(x[:, 0] > 0.3, 5.0, 1.0) + (np.nan_to_num(x[:, 1]) == 2) + rng.random(700)
    learn = rng.random(700) < 0.8
    g, h = boosted.gradients(boosted.TWEEDIE, y, np.full(700, 0.4))
    e = 1e-5
    for sign, got in ((1, g), (2, h)):  # derivatives of the deviance by differences
        f = lambda s: -y * np.exp(-0.5 * s) / -0.5 + np.exp(0.5 * s) / 0.5
        want = (f(0.4 + e) - f(0.4 - e)) / (2 * e) if sign == 1 else (f(0.4 + 1e-3) - 2 * f(0.4) + f(0.4 - 1e-3)) / 1e-6
        assert np.allclose(got, want, rtol=1e-4, atol=1e-6)
    bins = boosted.Bins(x, learn)
    assert (np.bincount(bins.feature) <= 256).all()
    g, h = g[learn], h[learn]
    gains = np.zeros(3)
    weight = boosted.grow(bins, learn, g, h, 1, gains)
    best = (-np.inf,)
    for f in range(3):
        for cut in range(bins.codes[:, f].max()):
            left = bins.codes[learn, f] <= cut
            if min(h[left].sum(), h[~left].sum()) >= 1:
                gain = g[left].sum() ** 2 / (h[left].sum() + 1) + g[~left].sum() ** 2 / (h[~left].sum() + 1) - g.sum() ** 2 / (h.sum() + 1)
                best = max(best, (gain, f, cut))
    gain, f, cut = best
    left = bins.codes[:, f] <= cut
    assert np.isclose(gains[f], gain) and gains.sum() == gains[f]
    for side in (left, ~left):
        assert np.allclose(weight[side], -g[side[learn]].sum() / (h[side[learn]].sum() + 1))


def test_deviance_falls_each_round_and_stages_are_prefixes():
    from tillwise.operators import boosted
    rng = np.random.default_rng(2)
    x = rng.integers(0, 12, (400, 4)).astype(float)
    y = rng.poisson(np.exp(0.2 * x[:, 0])) * rng.gamma(2, 1, 400)
    every = np.ones(400, bool)
    for objective in (boosted.SQUARED, boosted.TWEEDIE):
        stages, _ = boosted.boost(x, y, every, objective, 3, 0.1, list(range(1, 31)))
        if objective == boosted.TWEEDIE:
            loss = [np.mean(2 * y / np.sqrt(p) + 2 * np.sqrt(p)) for p in stages]
        else:
            loss = [np.mean((y - p) ** 2) for p in stages]
        assert all(b < a for a, b in zip(loss, loss[1:], strict=False))
        assert np.array_equal(boosted.boost(x, y, every, objective, 3, 0.1, [7])[0][0], stages[6])
    zero, _ = boosted.boost(x, np.zeros(400), every, boosted.TWEEDIE, 3, 0.3, [20])
    assert np.isfinite(zero[0]).all() and zero[0].max() < 1e-3


def test_run_log_schema(spark):
    from tillwise.sources.sinks import RUN_LOG_SCHEMA, run_log_rows
    best = spark.createDataFrame([("s", 7, 1.0, 2.0)], "series string, lag int, MAE double, R2 double")
    rows = run_log_rows(best, "2001-07-15", ["lag"], ["MAE", "R2"])
    assert [(f.name, f.dataType.simpleString()) for f in rows.schema.fields] == \
        [(f.name, f.dataType.simpleString()) for f in RUN_LOG_SCHEMA.fields]
    r = rows.first()
    assert r.params == {"lag": "7"} and r.metrics == {"MAE": 1.0, "R2": 2.0} and len(r.run_id) == 16


def test_cost_job_on_system_tables(spark, tmp_path):
    from tests.conftest import SF001
    from tillwise.plans.models import run_cost_forecast_job
    from tillwise.sources import fixtures
    from tillwise.sources.tables import Tables
    t = Tables(spark, SF001)
    base = str(tmp_path / "fc_sys")
    run_cost_forecast_job(spark, None, base, usage=fixtures.usage(t), prices=fixtures.list_prices(t))
    assert spark.read.parquet(base).count() == 30
