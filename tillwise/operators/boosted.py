"""Boosted-tree regression on daily series with contiguous-fold grid search.

The search space is the original's: trees x depth x learning rate x objective.  A
model of 1,000 trees passes through those of 100 and 500, so one run serves all
counts of trees, and a run is one group (series, objective, depth, rate, left-out
fold): all runs of all series advance in one Spark job, and a group holds the days
of one series, which the calendar bounds.  Spark deals out the rows, scores all
fold predictions in one grouped aggregation, averages folds and picks the winner.

A run grows second-order trees on histograms (Chen and Guestrin 2016): at each level
the gradient and curvature sums by (node, feature, bin) give every split's gain.
Squared error and Tweedie deviance (power 1.5, log link) differ in gradient and
curvature only.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.operators.metrics import regression_metrics

METRICS = ["MAE", "MSE", "RMSE", "R2", "MAPE"]
LOWER_IS_BETTER = {"MAE": True, "MSE": True, "RMSE": True, "MAPE": True, "R2": False}

# The original search spaces (54 and 27 candidates).
TREES, DEPTHS, RATES = (100, 500, 1000), (3, 6, 9), (0.01, 0.1, 0.3)
SQUARED, TWEEDIE = "reg:squarederror", "reg:tweedie"


def space(*objectives: str) -> list[dict]:
    names = ("objective", "max_depth", "learning_rate", "n_estimators")
    return [dict(zip(names, p, strict=True)) for p in itertools.product(objectives, DEPTHS, RATES, TREES)]


FULL_GRID, SQUARED_GRID = space(SQUARED, TWEEDIE), space(SQUARED)

#: Fixed values of the original's library: penalty on leaf weights, least curvature of a leaf, bins of a feature, Tweedie power.
PENALTY, LEAST_CURVATURE, MOST_BINS, POWER = 1.0, 1.0, 256, 1.5
LEAST_GAIN = 1e-6
REFIT = -1
FITTED = T.StructType([T.StructField("series", T.StringType()), T.StructField("param_id", T.IntegerType()), T.StructField("fold", T.IntegerType()),
                       T.StructField("DATA", T.DateType()), T.StructField("feature", T.IntegerType()), T.StructField("y", T.DoubleType()), T.StructField("value", T.DoubleType())])


class Bins:
    """Feature values as bin numbers; a missing value is in the first bin.  Bins come from the learning rows."""

    def __init__(self, x: np.ndarray, learn: np.ndarray):
        codes, sizes = [], []
        for column in x.T:
            edges = np.unique(column[learn & ~np.isnan(column)])[:-1]
            if len(edges) >= MOST_BINS:
                edges = np.unique(np.quantile(column[learn], np.arange(1, MOST_BINS) / MOST_BINS, method="lower"))
            codes.append(np.where(np.isnan(column), 0, np.searchsorted(edges, column, "left")))
            sizes.append(len(edges) + 1)
        self.codes = np.array(codes).T
        self.starts = np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64)
        self.feature = np.repeat(np.arange(len(sizes)), sizes)
        #: A cut after a feature's last bin parts nothing.
        self.last = np.zeros(len(self.feature), bool)
        self.last[np.cumsum(sizes) - 1] = True
        # most flags are zero on most days: only other bins are summed, the first one is what is left of the node
        self.row, feature = np.nonzero(self.codes[learn])
        self.bin = self.starts[feature] + self.codes[learn][self.row, feature]


def gradients(objective: str, y: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the loss by the score."""
    if objective == SQUARED:
        return score - y, np.ones(len(y))
    low, high = np.exp((1 - POWER) * score), np.exp((2 - POWER) * score)
    return high - y * low, (2 - POWER) * high - (1 - POWER) * y * low


def grow(bins: Bins, learn: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, gains: np.ndarray) -> np.ndarray:
    """Leaf weight of every row under a tree grown on the learning rows; ``gains`` adds up each feature's gain."""
    n, width = len(learn), len(bins.feature)
    out, node, k = np.zeros(n), np.zeros(n, np.int64), 1
    where = np.flatnonzero(learn)
    for level in range(depth + 1):
        own = node[where]
        live = own >= 0
        gs, hs = (np.bincount(own[live], v[live], k) for v in (g, h))
        weight = -gs / (hs + PENALTY)
        if level == depth:
            out[node >= 0] = weight[node[node >= 0]]
            break
        at = own[bins.row]
        used = at >= 0
        cell = at[used] * width + bins.bin[used]
        left = []
        for total, v in ((gs, g), (hs, h)):
            sums = np.bincount(cell, v[bins.row[used]], k * width).reshape(k, width)
            sums[:, bins.starts] = total[:, None] - np.add.reduceat(sums, bins.starts, axis=1)
            # every feature's bins add up to the node's total, so one running sum serves all features
            np.cumsum(sums, axis=1, out=sums)
            sums -= total[:, None] * bins.feature
            left.append(sums)
        (gl, hl), gr, hr = left, gs[:, None] - left[0], hs[:, None] - left[1]
        gain = gl * gl / (hl + PENALTY) + gr * gr / (hr + PENALTY)
        gain[(hl < LEAST_CURVATURE) | (hr < LEAST_CURVATURE) | bins.last] = -np.inf
        best = gain.argmax(axis=1)
        more = gain[np.arange(k), best] - np.square(gs) / (hs + PENALTY)
        split = more > LEAST_GAIN
        np.add.at(gains, bins.feature[best[split]], more[split])
        rows = np.flatnonzero(node >= 0)
        mine = node[rows]
        ends = ~split[mine]
        out[rows[ends]] = weight[mine[ends]]
        node[rows[ends]] = -1
        if not split.any():
            break
        rows, mine = rows[~ends], mine[~ends]
        feature = bins.feature[best[mine]]
        right = bins.codes[rows, feature] > best[mine] - bins.starts[feature]
        node[rows] = 2 * (np.cumsum(split) - 1)[mine] + right
        k = 2 * int(split.sum())
    return out


def boost(x: np.ndarray, y: np.ndarray, learn: np.ndarray, objective: str, depth: int, rate: float, stages: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """Predictions of all rows after each number of trees in ``stages``, and each feature's share of the gain."""
    bins = Bins(x, learn)
    mean = y[learn].mean()
    link = np.log if objective == TWEEDIE else (lambda v: v)
    score = np.full(len(y), link(max(mean, 1e-9) if objective == TWEEDIE else mean))
    gains, out = np.zeros(x.shape[1]), {}
    for tree in range(1, max(stages) + 1):
        g, h = gradients(objective, y[learn], score[learn])
        score += rate * grow(bins, learn, g, h, depth, gains)
        if tree in stages:
            out[tree] = np.exp(score) if objective == TWEEDIE else score.copy()
    return [out[s] for s in stages], gains / (gains.sum() or 1.0)


def _run(runs: list[dict]):
    def fit(key, rows):
        series, number, fold = (k.as_py() for k in key)
        run = runs[number]
        rows = rows.combine_chunks().sort_by("DATA")
        y, own = rows["y"].to_numpy(), rows["fold"].to_numpy()
        flat = rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        learn = (own != fold) & (own != REFIT)
        stages = sorted(n for n in run["params"])
        predicted, shares = boost(flat.reshape(len(y), -1), y, learn, run["objective"], run["max_depth"], run["learning_rate"], stages)
        out = []
        # of a fold's model its own days are wanted, of the refitted model the days that no fold has
        asked = np.flatnonzero(own == fold)
        for n, p in zip(stages, predicted, strict=True):
            out.append((run["params"][n], rows["DATA"].take(pa.array(asked)), None, y[asked], p[asked]))
        if fold == REFIT:
            out.append((run["params"][stages[-1]], None, np.arange(len(shares)), None, shares))
        parts = []
        for param, days, feature, actual, value in out:
            m = len(value)
            parts.append(pa.Table.from_arrays([
                pa.array([series] * m, pa.string()), pa.array([param] * m, pa.int32()), pa.array([fold] * m, pa.int32()),
                pa.nulls(m, pa.date32()) if days is None else days.combine_chunks().cast(pa.date32()), pa.nulls(m, pa.int32()) if feature is None else pa.array(feature, pa.int32()),
                pa.nulls(m, pa.float64()) if actual is None else pa.array(actual), pa.array(value)], names=FITTED.names))
        return pa.concat_tables(parts)

    return fit


def _fit(rows: DataFrame, features: dict[str, list[str]], grids: dict[str, list[dict]], wanted: list[tuple[str, int]], folds: list[int]) -> DataFrame:
    """Rows of FITTED for the (series, param_id) pairs of ``wanted`` and the left-out ``folds``."""
    spark = rows.sparkSession
    runs: dict[tuple, dict] = {}
    for series, pid in wanted:
        p = grids[series][pid]
        run = runs.setdefault((series, p["objective"], p["max_depth"], p["learning_rate"]), {**p, "series": series, "params": {}})
        run["params"][p["n_estimators"]] = pid
    listed = list(runs.values())
    table = spark.createDataFrame([(r["series"], i, f) for i, r in enumerate(listed) for f in folds], "series string, run int, out int")
    x = None
    for series, names in features.items():
        own = F.array(*(F.col(c).cast("double") for c in names))
        x = F.when(F.col("series") == series, own) if x is None else x.when(F.col("series") == series, own)
    packed = rows.where(F.col("y").isNotNull()).select("series", "DATA", F.col("y").cast("double").alias("y"), F.col("fold").cast("int").alias("fold"), x.alias("x"))
    # the list of runs is the size of the search space; a day without a fold is for the refitted model only
    dealt = packed.join(F.broadcast(table), "series").where((F.col("fold") != REFIT) | (F.col("out") == REFIT))
    keys = ["series", "run", "out"]
    # a fixed number of partitions: a run is small data and long work, so runs must not be put together
    spread = dealt.repartition(2 * len(listed) * len(folds), *keys)
    return spread.groupBy(*keys).applyInArrow(_run(listed), FITTED)


def cross_validate(trains: DataFrame, features: dict[str, list[str]], grids: dict[str, list[dict]], k: int = 5) -> DataFrame:
    """M3 + M4: (series, param_id, fold) metrics of every candidate on contiguous folds.

    ``trains`` holds the training days of all series (series, DATA, y, fold 0 to k - 1, features)."""
    wanted = [(s, i) for s, grid in grids.items() for i in range(len(grid))]
    fitted = _fit(trains.where(F.col("fold") != REFIT), features, grids, wanted, list(range(k)))
    return regression_metrics(fitted.select("series", "param_id", "fold", "y", F.col("value").alias("yhat")), ["series", "param_id", "fold"])


def refit(rows: DataFrame, features: dict[str, list[str]], grids: dict[str, list[dict]], chosen: dict[str, int]) -> DataFrame:
    """M5 + M6: rows of FITTED of each series' chosen candidate learnt from all folds: predictions of the
    days with fold -1, and the share of each feature (its place in the list) in the gain."""
    return _fit(rows, features, grids, list(chosen.items()), [REFIT])


def fold_means(cv: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Metrics averaged over folds per parameter set."""
    keys = keys or []
    return cv.groupBy(*keys, "param_id").agg(*[F.avg(m).alias(m) for m in METRICS])


def choose(means: DataFrame, refit: str, keys: list[str] | None = None) -> DataFrame:
    """Best parameter set by the refit metric (direction per metric; ties -> lowest id)."""
    keys = keys or []
    score = F.col(refit) if LOWER_IS_BETTER[refit] else -F.col(refit)
    # an undefined refit metric (MAPE of an all-zero series) ranks last; MAE then decides
    score = F.coalesce(score, F.lit(float("inf")))
    payload = F.struct("param_id", *METRICS)
    b = means.groupBy(*keys).agg(
        F.min_by(payload, F.struct(score, F.coalesce(F.col("MAE"), F.lit(float("inf"))), F.col("param_id"))).alias("b"))
    return b.select(*keys, "b.*")
