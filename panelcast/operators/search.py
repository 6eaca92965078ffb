"""Hyperparameter search as data: candidates are rows.

A series is one row (its ordered array) before candidates are attached, so the
fan-out multiplies short rows and no long group is ever built.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from panelcast.functions.calendar import future_array
from panelcast.functions.recursions import let
from panelcast.operators.grid import by_date, whole
from panelcast.session import spread

SCORED = ("series_id string, model string, candidate_id int, params map<string,string>, "
          "coef array<double>, n bigint, score double, status string")


Grid = dict[str, list[str]]

# Rounds, and the numbers that mix a digit with a key: with digits below 2**31, sums stay below 2**63.
FEISTEL_ROUNDS, MIX_DIGIT, MIX_KEY, MIX_PRIME = 4, 2_654_435_761, 48_271, 4_294_967_291


def grid_size(grid: Grid) -> int:
    return math.prod(len(values) for values in grid.values())


def grid_params(number: Column, grid: Grid) -> Column:
    """Parameters of candidate ``number``; the last name varies fastest."""
    entries, stride = [], grid_size(grid)
    for name, values in grid.items():
        stride //= len(values)
        digit = F.pmod(F.floor(number / stride), F.lit(len(values)))
        entries += [F.lit(name), F.element_at(F.array(*[F.lit(v) for v in values]), (digit + 1).cast("int"))]
    return F.create_map(*entries)


def explode_grid(rows: DataFrame, model: str, grid: Grid) -> DataFrame:
    """Every combination of ``grid`` for every row."""
    every = F.explode(F.sequence(F.lit(0), F.lit(grid_size(grid) - 1))).alias("candidate_id")
    return (rows.select("*", F.lit(model).alias("model"), every)
            .withColumn("params", grid_params(F.col("candidate_id"), grid)))


def drawn_numbers(model: str, grid: Grid, n_iter: int, seed: int = 0) -> Column:
    """``n_iter`` draws with replacement, repeats merged.

    The draws are hashes of series, draw number and seed, so a large grid is
    never expanded and a rerun draws the same candidates.
    """
    draw = lambda i: F.pmod(F.xxhash64(F.col("series_id"), F.lit(model), i, F.lit(seed)), F.lit(grid_size(grid)))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(n_iter)), draw)).cast("array<int>")


def sampled_numbers(model: str, grid: Grid, n_iter: int, seed: int = 0) -> Column:
    """``n_iter`` different candidates (all, if the grid is smaller).

    The first ``n_iter`` places of a permutation of the grid's numbers, keyed by
    series, model and seed: a Feistel network over the number as two digits in
    mixed radix.  Its four rounds are integer expressions, and each turns one
    digit by a function of the other, which can be undone: no number comes twice,
    and a grid is never built, whatever its size.  A grid of a prime number of
    candidates has one digit, which is only turned.
    """
    size = grid_size(grid)
    high = max(d for d in range(1, math.isqrt(size) + 1) if size % d == 0)
    digits = (high, size // high)
    text = F.sha2(F.concat_ws("|", F.col("series_id"), F.lit(model), F.lit(str(seed))), 256)
    keys = F.array(*[F.conv(F.substring(text, 8 * k + 1, 8), 16, 10).cast("long") for k in range(FEISTEL_ROUNDS)])

    def permuted(number: Column, key: Column) -> Column:
        parts = [F.floor(number / digits[1]), F.pmod(number, F.lit(digits[1]))]
        for k in range(FEISTEL_ROUNDS):
            mixed = F.floor(F.pmod(parts[1 - k % 2] * MIX_DIGIT + key[k] * MIX_KEY + k, F.lit(MIX_PRIME)) / 65536)
            parts[k % 2] = F.pmod(parts[k % 2] + mixed, F.lit(digits[k % 2]))
        return parts[0] * digits[1] + parts[1]

    places = F.sequence(F.lit(0).cast("long"), F.lit(min(n_iter, size) - 1).cast("long"))
    return let(keys, lambda key: F.transform(places, lambda i: permuted(i, key))).cast("array<int>")


def draw_grid(rows: DataFrame, model: str, grid: Grid, n_iter: int, seed: int = 0) -> DataFrame:
    """One row per drawn candidate, with replacement; see ``drawn_numbers``."""
    return _exploded(rows, model, grid, drawn_numbers(model, grid, n_iter, seed))


def sample_candidates(rows: DataFrame, model: str, grid: Grid, n_iter: int, seed: int = 0) -> DataFrame:
    """One row per sampled candidate, without replacement; see ``sampled_numbers``."""
    return _exploded(rows, model, grid, sampled_numbers(model, grid, n_iter, seed))


def _exploded(rows: DataFrame, model: str, grid: Grid, numbers: Column) -> DataFrame:
    return (rows.select("*", F.lit(model).alias("model"), F.explode(numbers).alias("candidate_id"))
            .withColumn("params", grid_params(F.col("candidate_id"), grid)))


# What a fit may raise on values it cannot work with; such a candidate fails, the job goes on.
FIT_ERRORS = (np.linalg.LinAlgError, ValueError, ArithmeticError)

FitOne = Callable[[np.ndarray, dict], tuple[np.ndarray, float, str]]


def refit(best: DataFrame, arrays: DataFrame, fit_one, value: str = "z") -> DataFrame:
    """Coefficients of chosen candidates on whole series.

    ``fit_one(values, ds, params)`` returns the coefficients; they are NULL
    where it fails.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, coefs = batch.copy(), []
            for values, ds, params in zip(batch[value], batch["ds"], batch["params"]):
                try:
                    with np.errstate(all="ignore"):
                        coefs.append(fit_one(np.asarray(values, float), np.asarray(ds, "datetime64[D]"), dict(params)))
                except FIT_ERRORS:
                    coefs.append(None)
            out["coef"] = coefs
            yield out

    rows = (best.drop("coef").select("series_id", "model", "params", "score")
            .join(arrays.select("series_id", "center", "scale", "ds", value), "series_id"))
    return spread(rows, "series_id", "model").mapInPandas(
        run, f"series_id string, model string, params map<string,string>, score double, center double, "
             f"scale double, ds array<date>, {value} array<double>, coef array<double>")


def fit_candidates(rows: DataFrame, fit_one: FitOne, value: str = "z") -> DataFrame:
    """Fit each (series, candidate) row; a failing one keeps its status.

    ``fit_one(values, params)`` returns ``(coef, score, status)``.  The rows
    are spread evenly over tasks, so a series with many candidates is not the
    work of one task.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            coefs, scores, notes = [], [], []
            for values, params in zip(batch[value], batch["params"]):
                try:
                    with np.errstate(all="ignore"):
                        coef, score, note = fit_one(np.asarray(values, float), dict(params))
                except FIT_ERRORS as error:
                    coef, score, note = np.array([]), np.nan, f"failed: {error}"
                coefs.append(coef)
                scores.append(float(score) if np.isfinite(score) else None)
                notes.append(note)
            yield pd.DataFrame({
                "series_id": batch["series_id"], "model": batch["model"], "candidate_id": batch["candidate_id"],
                "params": batch["params"], "coef": coefs, "n": batch[value].map(len).astype("int64"),
                "score": pd.array(scores, dtype="Float64"), "status": notes})

    needed = rows.select("series_id", "model", "candidate_id", "params", value)
    return spread(needed, "series_id", "candidate_id").mapInPandas(run, SCORED)


def apply_rows(rows: DataFrame, apply_one, steps: int, freq: str = "W-MON", value: str = "z") -> DataFrame:
    """Fits, forecasts and standard errors of fitted rows, as arrays.

    ``apply_one(values, ds, params, coef, future)`` returns three arrays: fits
    aligned to the end of the series, one forecast per date of ``future``, and
    standard errors (None where the model has no bands).  ``offset`` counts
    the first rows without a fit.  A row whose model fails, or has NULL
    coefficients, gets fits and forecasts that are not a number.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for i in range(len(batch)):
                row = batch.iloc[i]
                future = np.asarray(row["future"], "datetime64[D]")
                try:
                    if row["coef"] is None:
                        raise ValueError("no coefficients")
                    with np.errstate(all="ignore"):
                        made.append(apply_one(np.asarray(row[value], float), np.asarray(row["ds"], "datetime64[D]"),
                                              dict(row["params"]), np.asarray(row["coef"], float), future))
                except FIT_ERRORS:
                    made.append((np.full(len(row[value]), np.nan), np.full(len(future), np.nan), None))
            out = batch[["series_id", "model", "params", "center", "scale", "ds", value]].copy()
            out["fitted"] = [m[0] for m in made]
            out["ahead"] = [m[1] for m in made]
            out["stderr"] = [m[2] for m in made]
            out["offset"] = [len(z) - len(m[0]) for z, m in zip(batch[value], made)]
            yield out

    needed = rows.select("series_id", "model", "params", "coef", "center", "scale", "ds", value,
                         future_array(F.element_at("ds", -1), steps, freq).alias("future"))
    return needed.mapInPandas(
        run, "series_id string, model string, params map<string,string>, center double, scale double, "
             f"ds array<date>, {value} array<double>, fitted array<double>, ahead array<double>, "
             "stderr array<double>, offset int")


def kfold_candidates(rows: DataFrame, score_fold, folds: int = 3, value: str = "z") -> DataFrame:
    """Mean held-out squared error of each candidate over contiguous folds.

    Every (series, candidate, fold) is a row of its own.
    ``score_fold(values, ds, params, fold, folds)`` returns the fold's error.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = []
            for values, ds, params, fold in zip(batch[value], batch["ds"], batch["params"], batch["fold"]):
                try:
                    with np.errstate(all="ignore"):
                        error = score_fold(np.asarray(values, float), np.asarray(ds, "datetime64[D]"),
                                           dict(params), fold, folds)
                except FIT_ERRORS:
                    error = np.nan
                scores.append(float(error) if np.isfinite(error) else None)
            out = batch[["series_id", "model", "candidate_id", "params", "fold"]].copy()
            out["mse"] = pd.array(scores, dtype="Float64")
            yield out

    every = rows.select("series_id", "model", "candidate_id", "params", "ds", value,
                        F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("fold"))
    scored = spread(every, "series_id", "candidate_id", "fold").mapInPandas(run, "series_id string, model string, candidate_id int, "
                                     "params map<string,string>, fold int, mse double")
    # A candidate counts only if every fold could be scored.
    mean = F.when(F.count("mse") == folds, F.avg("mse"))
    return scored.groupBy("series_id", "model", "candidate_id").agg(
        F.first("params").alias("params"), mean.alias("score"),
        F.when(F.count("mse") == folds, "ok").otherwise("failed: a fold has no score").alias("status"))


def skip_failed_candidates(scored: DataFrame) -> DataFrame:
    return scored.where((F.col("status") == "ok") & F.col("score").isNotNull() & ~F.isnan("score"))


def pick_best_candidate(scored: DataFrame) -> DataFrame:
    """Smallest score per series and model; the first candidate on ties."""
    rest = [c for c in scored.columns if c not in ("series_id", "model")]
    return (skip_failed_candidates(scored).groupBy("series_id", "model")
            .agg(F.min_by(F.struct(*rest), F.struct("score", "candidate_id")).alias("b"))
            .select("series_id", "model", "b.*"))


def score_insample_rmse(fitted: DataFrame) -> DataFrame:
    """RMSE per candidate over rows ``(z, zhat)`` that have a fit."""
    return (fitted.where(F.col("zhat").isNotNull()).groupBy("series_id", "candidate_id")
            .agg(F.sqrt(F.avg(F.pow(F.col("z") - F.col("zhat"), 2))).alias("score"),
                 F.count("*").alias("n")))


def holdout_flag(panel: DataFrame, share: float = 0.8) -> DataFrame:
    """``is_train`` for the first ``int(share * n)`` rows of each series."""
    position, total = F.row_number().over(by_date()), F.count("*").over(whole())
    return panel.withColumn("is_train", position <= F.floor(total * share))


def score_holdout_rmse(fitted: DataFrame) -> DataFrame:
    """RMSE on the validation rows of ``holdout_flag``."""
    error = F.when(~F.col("is_train"), F.pow(F.col("z") - F.col("zhat"), 2))
    return fitted.groupBy("series_id", "candidate_id").agg(F.sqrt(F.avg(error)).alias("score"))


def fold_of(position: Column, total: Column, folds: int = 3) -> Column:
    """Contiguous unshuffled folds; the first ``total mod folds`` are one longer.

    ``position`` counts from 0.
    """
    small, longer = F.floor(total / folds), F.pmod(total, F.lit(folds))
    edge = longer * (small + 1)
    return F.when(position < edge, F.floor(position / (small + 1))).otherwise(
        longer + F.floor((position - edge) / small)).cast("int")


def kfold(rows: DataFrame, folds: int = 3) -> DataFrame:
    return rows.withColumn("fold", fold_of(F.row_number().over(by_date()) - 1, F.count("*").over(whole()), folds))


def information_criteria(sse: Column, n: Column, k: Column) -> dict[str, Column]:
    """AIC, BIC and AICc of a Gaussian model from its squared errors."""
    loss = n * F.log(sse / n)
    aic = loss + 2 * k
    return {"aic": aic, "bic": loss + k * F.log(n), "aicc": aic + 2 * k * (k + 1) / (n - k - 1)}
