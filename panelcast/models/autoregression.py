"""Autoregression by conditional least squares from grouped sums.

Cross products of (1, t, lags 1..5) are summed per series, head position and
season index in one aggregation that combines on the map side.  Those sums
hold every candidate: any subset of lags and trend terms, with or without
seasonal dummies, is a sub-matrix of them, so the panel is read once however
many candidates are searched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelcast.functions.calendar import base_freq
from panelcast.functions.recursions import normal_quantile, scan, stepped
from panelcast.operators.features import lag_from_end
from panelcast.operators.grid import by_date, whole
from panelcast.operators.search import SCORED, fold_of, grid_params, grid_size

MAX_LAG = 5
SEASON = {"D": 7, "W": 52, "M": 12, "Q": 4, "Y": 1}
TERMS = ["one", "t", *[f"lag_{k}" for k in range(1, MAX_LAG + 1)]]
PAIRS = [(i, j) for i in range(len(TERMS)) for j in range(i, len(TERMS))]
FIRST_SEASON = 2 + MAX_LAG      # coef: constant, slope, five lags, seasonal effects
SERIES_AT_ONCE = 64
SCORED_ARROW = pa.schema([
    ("series_id", pa.string()), ("model", pa.string()), ("candidate_id", pa.int32()), ("params", pa.map_(pa.string(), pa.string())),
    ("coef", pa.list_(pa.float64())), ("n", pa.int64()), ("score", pa.float64()), ("status", pa.string())])

GRID = {"lags": ["1", "2", "3", "4", "5"], "trend": ["n", "c", "t", "ct"], "seasonal": ["true", "false"]}


def design(train: DataFrame, season: int) -> DataFrame:
    """Rows with ``t`` from 1, lags (0 where absent), head and season index."""
    rows = train.withColumn("t", F.row_number().over(by_date()))
    lags = {f"lag_{k}": F.coalesce(F.lag("z", k).over(by_date()), F.lit(0.0)) for k in range(1, MAX_LAG + 1)}
    return rows.withColumns(lags).withColumns({
        "head": F.least(F.col("t") - 1, F.lit(MAX_LAG)), "season_index": F.pmod(F.col("t") - 1, F.lit(season))})


def moments(train: DataFrame, freq: str = "W-MON", seasonal: bool = True) -> DataFrame:
    """One row per series holding its sums by head position and season index.

    Candidates without seasonal dummies need no season index: with ``seasonal``
    off there is one part per head position.
    """
    rows = design(train, SEASON[base_freq(freq)] if seasonal else 1)
    term = {name: F.lit(1.0) if name == "one" else F.col(name).cast("double") for name in TERMS}
    sums = rows.groupBy("series_id", "head", "season_index").agg(
        F.array(*[F.sum(term[TERMS[i]] * term[TERMS[j]]) for i, j in PAIRS]).alias("xx"),
        F.array(*[F.sum(term[name] * F.col("z")) for name in TERMS]).alias("xz"),
        F.sum(F.col("z") * F.col("z")).alias("zz"), F.count("*").alias("n"))
    # At most one part per season index and head position, whatever the length.
    part = F.struct("head", "season_index", "xx", "xz", "zz", "n")
    parts = sums.groupBy("series_id").agg(F.sort_array(F.collect_list(part)).alias("m"))
    return parts.select("series_id", F.col("m.head").alias("head"), F.col("m.season_index").alias("season_index"),
                        F.flatten("m.xx").alias("xx"), F.flatten("m.xz").alias("xz"),
                        F.col("m.zz").alias("zz"), F.col("m.n").alias("n"))


class _Sums:
    """The sums of one series as matrices, totalled from each head position on."""

    def __init__(self, row, season):
        k = len(TERMS)
        head, index = np.asarray(row["head"]), np.asarray(row["season_index"])
        packed = np.asarray(row["xx"], float).reshape(len(head), len(PAIRS))
        xx = np.zeros((len(head), k, k))
        for position, (i, j) in enumerate(PAIRS):
            xx[:, i, j] = xx[:, j, i] = packed[:, position]
        xz = np.asarray(row["xz"], float).reshape(len(head), k)
        zz, n = np.asarray(row["zz"], float), np.asarray(row["n"], int)
        self.from_head = []
        for p in range(MAX_LAG + 1):
            used = head >= p
            cross, target, counts = np.zeros((season, k)), np.zeros(season), np.zeros(season)
            np.add.at(cross, index[used], xx[used, 0])
            np.add.at(target, index[used], xz[used, 0])
            np.add.at(counts, index[used], n[used])
            self.from_head.append((xx[used].sum(0), xz[used].sum(0), zz[used].sum(), int(n[used].sum()),
                                   cross, target, counts))

    def solve(self, params, season):
        p, trend, seasonal = int(params["lags"]), params["trend"], params["seasonal"] == "true"
        full, xz, zz, n, cross, target, counts = self.from_head[p]
        keep = ([0] if "c" in trend else []) + ([1] if "t" in trend else []) + list(range(2, 2 + p))
        dummies = np.flatnonzero(counts)[1 if "c" in trend else 0:] if seasonal and season > 1 else np.array([], int)
        a = np.block([[full[np.ix_(keep, keep)], cross[dummies][:, keep].T],
                      [cross[dummies][:, keep], np.diag(counts[dummies])]])
        b = np.r_[xz[keep], target[dummies]]
        if n <= len(b) + 1:
            return np.array([]), np.nan, n, "failed: too few rows"
        unit = 1 / np.sqrt(np.maximum(np.diag(a), 1e-12))
        scaled = a * unit[:, None] * unit
        try:
            x = unit * np.linalg.solve(scaled + 1e-12 * np.eye(len(b)), b * unit)
        except np.linalg.LinAlgError:
            x = unit * np.linalg.lstsq(scaled, b * unit, rcond=1e-11)[0]
        sse = max(zz - 2 * x @ b + x @ a @ x, 0.0)
        coef = np.zeros(FIRST_SEASON + season)
        coef[keep] = x[:len(keep)]
        coef[FIRST_SEASON + dummies] = x[len(keep):]
        return coef, float(np.sqrt(sse / n)), n, "ok"


def with_candidates(sums: DataFrame, numbers: Column | None = None) -> DataFrame:
    """Attach candidate numbers (all of the grid by default) and parameters."""
    numbers = numbers if numbers is not None else F.sequence(F.lit(0), F.lit(grid_size(GRID) - 1))
    return sums.withColumn("ids", numbers.cast("array<int>")).withColumn(
        "params", F.transform("ids", lambda i: grid_params(i, GRID)))


def with_fixed(sums: DataFrame, lags: int = 1, trend: str = "c", seasonal: bool = False) -> DataFrame:
    params = F.create_map(F.lit("lags"), F.lit(str(lags)), F.lit("trend"), F.lit(trend),
                          F.lit("seasonal"), F.lit(str(seasonal).lower()))
    return sums.withColumns({"ids": F.array(F.lit(0)), "params": F.array(params)})


def fit_ar(rows: DataFrame, freq: str = "W-MON") -> DataFrame:
    """Solve the candidates of each series from its sums, unpacked once.

    A batch of Spark may hold thousands of series, and every series gives as many
    rows as it has candidates: a few series are unpacked, solved and returned at a time.
    """
    season = SEASON[base_freq(freq)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SERIES_AT_ONCE):
                parts = []
                for row in batch.slice(start, SERIES_AT_ONCE).to_pandas().to_dict("records"):
                    sums, every = _Sums(row, season), [dict(p) for p in row["params"]]
                    solved = [sums.solve(params, season) for params in every]
                    parts += [(row["series_id"], "ar", i, list(p.items()), s[0], s[2], None if np.isnan(s[1]) else s[1], s[3])
                              for i, p, s in zip(row["ids"], every, solved)]
                columns = list(zip(*parts)) or [[] for _ in SCORED_ARROW]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCORED_ARROW)], schema=SCORED_ARROW)

    return rows.mapInArrow(run, SCORED)


def _level(coef: Column, t: Column) -> Column:
    """Constant, slope and seasonal effect at time ``t`` (from 1)."""
    season = F.size(coef) - FIRST_SEASON
    return coef[0] + coef[1] * t + coef[(F.lit(FIRST_SEASON) + F.pmod(t - 1, season)).cast("int")]


def ar_fitted(train: DataFrame, best: DataFrame, freq: str = "W-MON") -> DataFrame:
    """One-step predictions ``zhat``; none for the first ``lags`` rows."""
    rows = design(train, SEASON[base_freq(freq)]).join(best.select("series_id", "model", "params", "coef"), "series_id")
    coef = F.col("coef")
    zhat = _level(coef, F.col("t"))
    for k in range(1, MAX_LAG + 1):
        zhat = zhat + coef[1 + k] * F.col(f"lag_{k}")
    return (rows.withColumn("zhat", zhat).where(F.col("t") > F.col("params")["lags"].cast("int"))
            .drop("one", "head", "season_index", *TERMS[1:]))


def forecast_array(steps: int) -> Column:
    """Forecasts from the columns ``z`` (history array) and ``coef``."""
    coef, n = F.col("coef"), F.size("z")

    def grow(history: Column, h: Column) -> Column:
        point = _level(coef, n + h)
        for k in range(1, MAX_LAG + 1):
            point = point + coef[1 + k] * lag_from_end(history, k)
        return F.concat(history, F.array(point))

    start = F.slice(F.col("z"), F.greatest(n - MAX_LAG + 1, F.lit(1)), MAX_LAG)
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, grow,
                       lambda h: F.slice(h, F.size(h) - steps + 1, steps))


def stderr_array(steps: int) -> Column:
    """Forecast standard errors: sigma times the root of summed squared weights
    of past shocks (``coef`` gives the weights, ``score`` is sigma)."""
    coef = F.col("coef")

    def step(state: Column, _: Column) -> Column:
        weights, total = state["w"], state["v"]
        following = F.lit(0.0)
        for k in range(1, MAX_LAG + 1):
            following = following + coef[1 + k] * weights[k - 1]
        new = F.concat(F.array(following), F.slice(weights, 1, MAX_LAG - 1))
        return stepped(F.struct(new.alias("w"), (total + following * following).alias("v")),
                       F.col("score") * F.sqrt(total))

    first = F.array(*[F.lit(1.0 if k == 0 else 0.0) for k in range(MAX_LAG)])
    zero = F.struct(first.alias("w"), F.lit(1.0).alias("v"))
    return scan(F.sequence(F.lit(1), F.lit(steps)), zero, step, "double")["out"]


def predict(best: DataFrame, arrays: DataFrame, steps: int, alpha: float = 0.05) -> DataFrame:
    """Forecast and band arrays on the scaled values."""
    rows = best.join(arrays, "series_id").withColumns({"ahead": forecast_array(steps), "_se": stderr_array(steps)})
    reach = normal_quantile(alpha)
    return rows.withColumns({
        "lower": F.zip_with("ahead", "_se", lambda f, s: f - reach * s),
        "upper": F.zip_with("ahead", "_se", lambda f, s: f + reach * s)}).drop("_se")


def block_sums(train: DataFrame, lags: int = MAX_LAG, blocks: int = 3) -> DataFrame:
    """One row per series: Gram sums of the rows that have all ``lags``, by contiguous blocks of time."""
    rows = design(train, 1).where(F.col("head") >= lags)
    rows = rows.withColumn("block", fold_of(F.row_number().over(by_date()) - 1, F.count("*").over(whole()), blocks))
    term = {name: F.lit(1.0) if name == "one" else F.col(name).cast("double") for name in TERMS}
    sums = rows.groupBy("series_id", "block").agg(
        F.array(*[F.sum(term[TERMS[i]] * term[TERMS[j]]) for i, j in PAIRS]).alias("xx"),
        F.array(*[F.sum(term[name] * F.col("z")) for name in TERMS]).alias("xz"),
        F.sum(F.col("z") * F.col("z")).alias("zz"), F.count("*").alias("n"))
    parts = F.sort_array(F.collect_list(F.struct("block", "xx", "xz", "zz", "n")))  # at most ``blocks``
    return sums.groupBy("series_id").agg(parts.alias("b")).select(
        "series_id", F.flatten("b.xx").alias("xx"), F.flatten("b.xz").alias("xz"), F.col("b.zz").alias("zz"), F.col("b.n").alias("n"))


def score_blocks(sums: DataFrame, candidates: list[dict[str, str]], rolling: bool = False) -> DataFrame:
    """Mean held-out squared error of every candidate (``lags``, ``trend``) from the sums of ``block_sums``.

    Leaving a block out is a subtraction: the sums of the training rows are the
    total less the block's, and the error on the block follows from its own sums,
    so no row is read again.  With ``rolling`` a block is forecast from the blocks
    before it, whose sums are running totals.  A candidate with a block that
    cannot be scored fails.
    """
    k = len(TERMS)

    def errors(xx, xz, zz, n, keep) -> np.ndarray:
        train = [np.cumsum(x, 0) - x if rolling else x.sum(0) - x for x in (xx, xz, n)]
        out = []
        for f in range(1 if rolling else 0, len(n)):
            a, b = train[0][f][np.ix_(keep, keep)], train[1][f][keep]
            if train[2][f] <= len(keep) + 1:
                return np.array([np.nan])
            unit = 1 / np.sqrt(np.maximum(np.diag(a), 1e-12))
            x = unit * np.linalg.lstsq(a * unit[:, None] * unit, b * unit, rcond=1e-12)[0]
            out.append((zz[f] - 2 * x @ xz[f][keep] + x @ xx[f][np.ix_(keep, keep)] @ x) / n[f])
        return np.maximum(out, 0.0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for series, packed, xz, zz, n in batch[["series_id", "xx", "xz", "zz", "n"]].itertuples(index=False):
                packed, xx = np.reshape(packed, (len(n), len(PAIRS))), np.zeros((len(n), k, k))
                for place, (i, j) in enumerate(PAIRS):
                    xx[:, i, j] = xx[:, j, i] = packed[:, place]
                for number, params in enumerate(candidates):
                    keep = [i for i, c in enumerate("ct") if c in params["trend"]] + list(range(2, 2 + int(params["lags"])))
                    found = errors(xx, np.reshape(xz, (len(n), k)), np.asarray(zz, float), np.asarray(n, float), keep)
                    score = float(found.mean()) if len(found) else np.nan
                    rows.append((series, "ar", number, params, score, "ok" if np.isfinite(score) else "failed: a block has no score"))
            out = pd.DataFrame(rows, columns=["series_id", "model", "candidate_id", "params", "score", "status"])
            out["score"] = out["score"].astype("Float64")
            yield out

    return sums.mapInPandas(run, "series_id string, model string, candidate_id int, params map<string,string>, score double, status string")
