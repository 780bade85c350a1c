"""Additive trend + seasonality + holiday forecaster, tuned per series.

Own design after Taylor & Letham (2018), "Forecasting at scale":
piecewise-linear trend with hinge terms at changepoints placed evenly over
the first 80 % of the history, Fourier terms for yearly (order 10) and
weekly (order 3) seasonality, and one indicator per holiday name.  Holiday
effects (scale ``holidays_prior_scale``) and seasonality (scale 10) have
Gaussian priors, changepoint slopes a Laplace prior of scale
``changepoint_prior_scale``, which leaves most of them near zero; it is solved
by reweighted ridge steps on the Gram matrix.  A seasonality is used only when
the history spans two of its periods.

The 80 % band comes from seeded draws of the future: trend changes at the rate
of the history's changepoints, of Laplace size with the mean size of the
history's slopes, plus the residual deviation; quantiles are taken day by day,
so the band widens with the horizon.

Distribution: Spark builds the rows (history + future days, holiday names
per day); the numeric fit is one small dense solve per group in
``applyInPandas``.  Tuning groups by (series, number of changepoints): the
parameter sets that differ in their prior scales alone share a design.  Refits
and tracking group by series; a group is the days of one series.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The tuning grid (changepoint prior scale x holiday prior
# scale x number of changepoints), the seasonality orders, the share of the
# history that may hold changepoints and the band z-score.
CHANGEPOINT_PRIOR_SCALES = [0.01, 0.05, 0.08, 0.1, 0.3]
HOLIDAY_PRIOR_SCALES = [0.1, 0.2, 0.3, 0.4, 0.5]
N_CHANGEPOINTS = [100, 150, 200]
YEARLY_ORDER, WEEKLY_ORDER = 10, 3
SEASONALITY_PRIOR_SCALE = 10.0
CHANGEPOINT_RANGE = 0.8
BAND_Z = 1.2816
LAPLACE_STEPS, LAPLACE_CLOSE, LAPLACE_FLOOR = 30, 1e-5, 1e-6
DRAWS, SEED = 1000, 20_010_715
NOISE_VAR = 0.01  # assumed residual variance on the scaled target, turns priors into ridge weights

GRID = [dict(param_id=i, changepoint_prior_scale=c, holidays_prior_scale=h, n_changepoints=n)
        for i, (c, h, n) in enumerate(itertools.product(
            CHANGEPOINT_PRIOR_SCALES, HOLIDAY_PRIOR_SCALES, N_CHANGEPOINTS))]

TUNE_SCHEMA = ("series string, param_id int, changepoint_prior_scale double, holidays_prior_scale double, "
               "n_changepoints int, n_train int, n_test int, n_zero_actual int, mape double")
FORECAST_SCHEMA = "series string, ds date, yhat double, yhat_lower double, yhat_upper double"


class AdditiveModel:
    """Ridge fit of the additive design on one series (numpy, used inside tasks)."""

    def __init__(self, changepoint_prior_scale: float, holidays_prior_scale: float, n_changepoints: int):
        self.cps = float(changepoint_prior_scale)
        self.hps = float(holidays_prior_scale)
        self.n_cp = int(n_changepoints)

    @staticmethod
    def _days(ds: pd.Series) -> np.ndarray:
        return (pd.to_datetime(ds).values.astype("datetime64[D]").astype(np.int64)).astype(float)

    def _design(self, days: np.ndarray, holidays: list) -> np.ndarray:
        t = (days - self.t0) / self.span
        cols = [np.ones_like(t), t]
        cols += [np.maximum(0.0, t - c) for c in self.changepoints]
        for period, order in self.seasons:
            for k in range(1, order + 1):
                ang = 2.0 * np.pi * k * days / period
                cols += [np.sin(ang), np.cos(ang)]
        hol = np.zeros((len(days), len(self.holiday_names)))
        index = {n: j for j, n in enumerate(self.holiday_names)}
        for i, names in enumerate(holidays):  # only rows carrying holidays do work
            if names is not None:
                for n in names:
                    j = index.get(n)
                    if j is not None:
                        hol[i, j] = 1.0
        return np.column_stack(cols + [hol])

    def _penalty(self, slopes: np.ndarray) -> np.ndarray:
        """One ridge penalty for each column of the design; the slopes' own sizes make theirs a Laplace prior's."""
        waves = 2 * sum(order for _, order in self.seasons)
        return np.concatenate([[1e-6, 1e-6], NOISE_VAR / (self.cps * np.maximum(np.abs(slopes), LAPLACE_FLOOR)),
                               np.full(waves, NOISE_VAR / SEASONALITY_PRIOR_SCALE ** 2),
                               np.full(len(self.holiday_names), NOISE_VAR / self.hps ** 2)])

    def fit(self, ds: pd.Series, y: pd.Series, holidays: list) -> "AdditiveModel":
        return self.prepare(ds, y, holidays).solve(self.cps, self.hps)

    def prepare(self, ds: pd.Series, y: pd.Series, holidays: list) -> "AdditiveModel":
        """The design and its products, which no prior scale changes."""
        days = self._days(ds)
        order = np.argsort(days, kind="stable")
        days, yv = days[order], np.asarray(y, dtype=float)[order]
        hols = [holidays[i] for i in order]
        self.t0, t1 = days[0], days[-1]
        self.span = (t1 - self.t0) if t1 > self.t0 else 1.0
        hist = int(np.floor(len(days) * CHANGEPOINT_RANGE))
        n_cp = min(self.n_cp, max(hist - 1, 0))
        if n_cp > 0:
            idx = np.linspace(0, hist - 1, n_cp + 1).round().astype(int)[1:]
            self.changepoints = (days[idx] - self.t0) / self.span
        else:
            self.changepoints = np.array([])
        # a seasonality is fitted only with two full periods of history: Fourier
        # terms fitted on a fraction of a year extrapolate wildly
        self.seasons = [(per, order) for per, order in ((365.25, YEARLY_ORDER), (7.0, WEEKLY_ORDER))
                        if (t1 - self.t0) >= 2 * per]
        self.holiday_names = sorted({n for h in hols if h is not None for n in h})
        scale = float(np.max(np.abs(yv))) if len(yv) else 1.0
        self.y_scale = scale if scale > 0 else 1.0
        self.yv, self.X = yv, self._design(days, hols)
        self.gram, self.moments = self.X.T @ self.X, self.X.T @ (yv / self.y_scale)
        return self

    def solve(self, changepoint_prior_scale: float, holidays_prior_scale: float) -> "AdditiveModel":
        """Coefficients under the two prior scales."""
        self.cps, self.hps = float(changepoint_prior_scale), float(holidays_prior_scale)
        self.beta = self._coefficients()
        resid = self.yv - (self.X @ self.beta) * self.y_scale
        self.sigma = float(np.std(resid)) if len(resid) > 1 else 0.0
        return self

    def _coefficients(self) -> np.ndarray:
        """The reweighted ridge steps, from slopes of the prior's scale until they settle."""
        n = len(self.changepoints)
        slopes = np.full(n, self.cps)
        for _ in range(LAPLACE_STEPS if n else 1):
            beta = np.linalg.solve(self.gram + np.diag(self._penalty(slopes)), self.moments)
            moved = np.max(np.abs(beta[2:2 + n] - slopes), initial=0.0)
            slopes = beta[2:2 + n]
            if moved < LAPLACE_CLOSE:
                break
        return beta

    def add_day(self, day: pd.Timestamp, y: float, holidays) -> None:
        """One more day of history on the same design: its products grow by one row's."""
        row = self._design(self._days(pd.Series([day])), [holidays])
        self.X, self.yv = np.vstack([self.X, row]), np.append(self.yv, y)
        self.gram, self.moments = self.gram + row.T @ row, self.moments + row[0] * (y / self.y_scale)

    def point(self, ds: pd.Series, holidays: list) -> np.ndarray:
        return (self._design(self._days(ds), holidays) @ self.beta) * self.y_scale

    def _trend_changes(self, t: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """What trend changes after the history (t = 1) may add to the scaled forecast: draws x days."""
        n = len(self.changepoints)
        size = np.mean(np.abs(self.beta[2:2 + n])) if n else 0.0
        ahead = max(t.max(initial=1.0) - 1.0, 0.0)
        counts = rng.poisson(n * ahead, DRAWS) if size > 0 else np.zeros(DRAWS, int)
        most = int(counts.max(initial=0))
        at, slope = 1.0 + ahead * rng.random((DRAWS, most)), rng.laplace(0.0, size or 1.0, (DRAWS, most))
        slope[np.arange(most)[None, :] >= counts[:, None]] = 0.0
        out = np.zeros((DRAWS, len(t)))
        for j in range(most):
            out += slope[:, j, None] * np.maximum(0.0, t[None, :] - at[:, j, None])
        return out

    def predict(self, ds: pd.Series, holidays: list) -> pd.DataFrame:
        """Forecast with its band: residual spread on days of the history, simulated after it."""
        yhat = self.point(ds, holidays)
        half = np.full(len(yhat), BAND_Z * self.sigma)
        lower, upper = yhat - half, yhat + half
        t = (self._days(ds) - self.t0) / self.span
        after = t > 1.0
        if after.any():
            rng = np.random.default_rng(SEED)
            drawn = self._trend_changes(t[after], rng) * self.y_scale + rng.normal(0.0, 1.0, (DRAWS, int(after.sum()))) * self.sigma
            low, high = np.quantile(drawn, [0.1, 0.9], axis=0)
            lower[after], upper[after] = yhat[after] + low, yhat[after] + high
        return pd.DataFrame({"yhat": yhat, "yhat_lower": lower, "yhat_upper": upper})


def _mape(y: np.ndarray, yhat: np.ndarray) -> tuple[float, int]:
    """mean |(y - |yhat|) / y| x 100 over days with y != 0; also the number of y == 0 days."""
    nz = y != 0
    if not nz.any():
        return float("nan"), int((~nz).sum())
    return float(np.mean(np.abs((y[nz] - np.abs(yhat[nz])) / y[nz])) * 100), int((~nz).sum())


def _tune_group(train_end: np.datetime64, horizon: int, grid: list[dict]):
    """Every parameter set with one number of changepoints, on one series: they share a design."""
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = [p for p in grid if p["n_changepoints"] == int(pdf["n_changepoints"].iloc[0])]
        pdf = pdf.sort_values("ds", kind="stable")
        ds = pd.to_datetime(pdf["ds"])
        tr = pdf[ds < train_end]
        te = pdf[ds >= train_end]
        if len(tr) >= 2:
            m = AdditiveModel(sets[0]["changepoint_prior_scale"], sets[0]["holidays_prior_scale"], sets[0]["n_changepoints"])
            m.prepare(tr["ds"], tr["y"], list(tr["holidays"]))
            future = pd.date_range(pd.to_datetime(tr["ds"]).max() + pd.Timedelta(days=1), periods=horizon, freq="D")
            te = te[pd.to_datetime(te["ds"]).isin(future)]  # forecast days that have an actual
            days, actual = list(te["holidays"]), te["y"].to_numpy(dtype=float)
        out = []
        for p in sets:
            row = dict(series=pdf["series"].iloc[0], **p, n_train=len(tr), n_test=0, n_zero_actual=0, mape=float("nan"))
            if len(tr) >= 2 and len(te):
                mape, zeros = _mape(actual, m.solve(p["changepoint_prior_scale"], p["holidays_prior_scale"]).point(te["ds"], days))
                row.update(n_test=len(te), n_zero_actual=zeros, mape=mape)
            out.append(row)
        return pd.DataFrame(out)[[f.split()[0] for f in TUNE_SCHEMA.split(", ")]]
    return fn


def _forecast_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("ds", kind="stable")
    hist = pdf[pdf["y"].notna()]
    m = AdditiveModel(pdf["changepoint_prior_scale"].iloc[0], pdf["holidays_prior_scale"].iloc[0],
                      pdf["n_changepoints"].iloc[0])
    m.fit(hist["ds"], hist["y"], list(hist["holidays"]))
    pred = m.predict(pdf["ds"], list(pdf["holidays"]))
    return pd.concat([pdf[["series", "ds"]].reset_index(drop=True), pred], axis=1)


def holidays_by_day(holidays: DataFrame, date_col: str = "ds") -> DataFrame:
    """(ds, holidays array<string>): one row per date, names de-duplicated."""
    return holidays.groupBy(F.col(date_col).cast("date").alias("ds")).agg(
        F.array_sort(F.collect_set("holiday")).alias("holidays"))


def prepare_history(series: DataFrame, holidays: DataFrame, as_of: str) -> DataFrame:
    """P10 + P11: rows before ``as_of`` with a value, holiday names attached."""
    h = (series.select("series", F.col("ds").cast("date").alias("ds"), F.col("y").cast("double").alias("y"))
         .na.drop("any").where(F.col("ds") < F.to_date(F.lit(as_of))))
    return h.join(F.broadcast(holidays_by_day(holidays)), "ds", "left")


def tune(history: DataFrame, as_of: str, holdout_days: int = 31, horizon: int = 30,
         grid: list[dict] | None = None) -> DataFrame:
    """M9: holdout MAPE of every parameter set.  The history goes once to each (series, number
    of changepoints); the sets that differ in their prior scales alone are solved on one design."""
    grid = grid or GRID
    train_end = np.datetime64(pd.Timestamp(as_of) - pd.Timedelta(days=holdout_days), "ns")
    sizes = F.explode(F.array(*[F.lit(n) for n in sorted({p["n_changepoints"] for p in grid})]))
    rows = history.select("*", sizes.alias("n_changepoints"))
    return rows.groupBy("series", "n_changepoints").applyInPandas(_tune_group(train_end, horizon, grid), TUNE_SCHEMA)


def best_parameters(tuned: DataFrame) -> DataFrame:
    """Lowest MAPE per series; ties -> smallest parameter id."""
    cols = ["param_id", "changepoint_prior_scale", "holidays_prior_scale", "n_changepoints", "mape"]
    b = tuned.where(F.col("mape").isNotNull() & ~F.isnan("mape")).groupBy("series").agg(
        F.min_by(F.struct(*cols), F.struct("mape", "param_id")).alias("b"))
    return b.select("series", "b.*")


def forecast(history: DataFrame, best: DataFrame, holidays: DataFrame, horizon: int = 30) -> DataFrame:
    """M10 + M11: refit on all history with the chosen parameters; history + ``horizon`` days."""
    last = history.groupBy("series").agg(F.max("ds").alias("_last"))
    future = last.select("series", F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon)))
                         .alias("ds")).join(F.broadcast(holidays_by_day(holidays)), "ds", "left")
    rows = history.unionByName(future.withColumn("y", F.lit(None).cast("double")))
    params = best.select("series", "changepoint_prior_scale", "holidays_prior_scale", "n_changepoints")
    return rows.join(params, "series").groupBy("series").applyInPandas(_forecast_group, FORECAST_SCHEMA)


def _track_group(first: str, last: str):
    """The month's forecasts of one series: of the run on the first day, and of each day's own run."""
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds", kind="stable")
        ds = pd.to_datetime(pdf["ds"])
        before, month = pdf[ds < pd.Timestamp(first)], pdf[(ds >= pd.Timestamp(first)) & (ds <= pd.Timestamp(last))]
        before = before[before["y"].notna()]
        if len(before) < 2:
            return pd.DataFrame({c: [] for c in ("series", "data", "previsao_inicial", "previsao_ajustada", "real")})
        p = pdf.iloc[0]
        m = AdditiveModel(p["changepoint_prior_scale"], p["holidays_prior_scale"], p["n_changepoints"])
        m.fit(before["ds"], before["y"], list(before["holidays"]))
        start, own = m.point(month["ds"], list(month["holidays"])), []
        for day, y, holidays in zip(month["ds"], month["y"], month["holidays"], strict=True):
            own.append(m.point(pd.Series([day]), [holidays])[0])
            if not np.isnan(y):  # the day becomes history for the next run
                m.add_day(day, y, holidays)
                m.solve(m.cps, m.hps)
        return pd.DataFrame({"series": month["series"], "data": month["ds"], "previsao_inicial": start, "previsao_ajustada": own, "real": month["y"]})
    return fn


def track(series: DataFrame, best: DataFrame, holidays: DataFrame, first: str, last: str) -> DataFrame:
    """M17 on the trained model: for each day from ``first`` to ``last``, the forecast of the run on ``first``
    and of the run on the day itself (data to the day before), and the realised value.

    The design (time scale, changepoints, holiday names) is that of the first run, so each day's
    refit adds one row to its products and solves once; it equals a refit on all rows of that design."""
    rows = series.select("series", F.col("ds").cast("date").alias("ds"), F.col("y").cast("double").alias("y")).where(F.col("ds") <= F.to_date(F.lit(last)))
    days = rows.select("series").distinct().select("series", F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))).alias("ds"))
    rows = rows.join(days, ["series", "ds"], "full")
    rows = rows.join(F.broadcast(holidays_by_day(holidays)), "ds", "left")
    params = best.select("series", "changepoint_prior_scale", "holidays_prior_scale", "n_changepoints")
    return rows.join(params, "series").groupBy("series").applyInPandas(_track_group(first, last), "series string, data date, previsao_inicial double, previsao_ajustada double, real double")
