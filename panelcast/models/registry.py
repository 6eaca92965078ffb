"""Forecaster families by name, and the steps every family goes through.

A family is data: a search function giving the best candidate per series, and
a predict function turning fitted rows into fit, forecast and band arrays.
Both take the one-row-per-series table (``series_id, center, scale, ds, z``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from panelcast.functions.calendar import lags_of
from panelcast.functions.recursions import normal_quantile
from panelcast.models import arima, autoregression, bayes, decomposable, learners, smoothing, statespace
from panelcast.operators.search import (apply_rows, draw_grid, explode_grid, fit_candidates, kfold_candidates,
                                        pick_best_candidate, refit, sample_candidates, sampled_numbers)


@dataclass(frozen=True)
class Family:
    """``search(arrays, freq, n_iter, seed)`` returns one row per series with
    ``model, params, score``; ``predict(best, arrays, steps, freq, alpha)``
    refits where needed and returns arrays."""

    search: Callable[..., DataFrame]
    predict: Callable[..., DataFrame]
    has_bands: bool
    version: str = ""  # part of a stored fit's key, such as the text of the grid


def _with_bands(rows: DataFrame, alpha: float) -> DataFrame:
    reach = normal_quantile(alpha)
    return rows.withColumns({
        "lower": F.zip_with("ahead", "stderr", lambda f, s: f - reach * s),
        "upper": F.zip_with("ahead", "stderr", lambda f, s: f + reach * s)}).drop("stderr")


def _smoothing(model: str, grid) -> Family:
    def search(arrays, freq, n_iter=50, seed=0):
        return pick_best_candidate(smoothing.search(arrays, model, grid(freq), n_iter, seed))

    def predict(best, arrays, steps, freq, alpha=0.05, refit_rows=False):
        if refit_rows:
            best = pick_best_candidate(fit_candidates(_again(best, arrays), smoothing.fit_smoothing))
        kept = best.select("series_id", "model", "params", "coef")
        return smoothing.predict(kept, arrays, steps, alpha).withColumn("offset", F.lit(0))
    return Family(search, predict, True, repr(grid("W-MON")))


def _again(best: DataFrame, arrays: DataFrame) -> DataFrame:
    """Chosen candidates with the arrays to refit them on."""
    return (best.select("series_id", "model", "params").withColumn("candidate_id", F.lit(0))
            .join(arrays.select("series_id", "z"), "series_id"))


def _array_model(model: str, grid, fit_one, apply_one, draw=draw_grid, bands=True) -> Family:
    """Families fitted on the array of a series and scored in sample."""
    def search(arrays, freq, n_iter=50, seed=0):
        return pick_best_candidate(fit_candidates(
            draw(arrays.select("series_id", "z"), model, grid(freq), n_iter, seed), fit_one))

    def predict(best, arrays, steps, freq, alpha=0.05, refit_rows=False):
        if refit_rows:
            best = pick_best_candidate(fit_candidates(_again(best, arrays), fit_one))
        rows = best.select("series_id", "model", "params", "coef").join(arrays, "series_id")
        return _with_bands(apply_rows(rows, apply_one, steps, freq), alpha)
    return Family(search, predict, bands, repr(grid("W-MON")))


def _validated_model(model: str, grid, parts, folds: int, draw, bands: bool) -> Family:
    """Families scored on held-out rows, then refitted on the whole series."""
    def search(arrays, freq, n_iter=50, seed=0):
        score_fold, _, _ = parts(freq)
        rows = draw(arrays, model, grid, n_iter, seed)
        return pick_best_candidate(kfold_candidates(rows, score_fold, folds))

    def predict(best, arrays, steps, freq, alpha=0.05, refit_rows=True):
        _, fit, apply_one = parts(freq)
        rows = refit(best, arrays, fit)
        return _with_bands(apply_rows(rows, apply_one, steps, freq), alpha)
    return Family(search, predict, bands, repr(grid))


def _grid_only(rows, model, grid, n_iter, seed):
    del n_iter, seed
    return explode_grid(rows, model, grid)


def _rows(arrays: DataFrame) -> DataFrame:
    return (arrays.select("series_id", "center", "scale", F.explode(F.arrays_zip("ds", "z")).alias("r"))
            .select("series_id", "center", "scale", "r.ds", "r.z"))


def _ar(fixed: bool = False) -> Family:
    """Autoregression: every candidate comes from one set of grouped sums.  ``fixed``: one lag and a constant, no search."""
    model = autoregression

    def search(arrays, freq, n_iter=50, seed=0):
        sums = model.moments(_rows(arrays), freq, seasonal=not fixed)
        if fixed:
            return pick_best_candidate(model.fit_ar(model.with_fixed(sums), freq))
        chosen = sampled_numbers("ar", model.GRID, n_iter, seed)
        return pick_best_candidate(model.fit_ar(model.with_candidates(sums, chosen), freq))

    def predict(best, arrays, steps, freq, alpha=0.05, refit_rows=False):
        if refit_rows:
            again = best.select("series_id", F.array(F.lit(0)).alias("ids"), F.array("params").alias("params"))
            sums = model.moments(_rows(arrays), freq, seasonal=not fixed)
            anew = pick_best_candidate(model.fit_ar(sums.join(again, "series_id"), freq))
            best = anew.drop("model").join(best.select("series_id", "model"), "series_id")
        kept = best.select("series_id", "model", "params", "coef", "score")
        fits = (model.ar_fitted(_rows(arrays), kept, freq).groupBy("series_id")
                .agg(F.sort_array(F.collect_list(F.struct("ds", "zhat"))).alias("f"))
                .select("series_id", F.col("f.zhat").alias("fitted")))
        return (model.predict(kept, arrays, steps, alpha).join(fits, "series_id")
                .withColumn("offset", F.size("z") - F.size("fitted")))
    return Family(search, predict, True)


def _fixed_smoothing(trend: str, alpha: float, beta: float) -> Family:
    """Level or level-and-trend smoothing with given weights: the recursion, its forecasts and bands as expressions."""
    def smoothed(arrays):
        weights = {"trend": F.lit(trend), "alpha": F.lit(alpha), "beta": F.lit(beta), "gamma": F.lit(0.0), "phi": F.lit(1.0)}
        return smoothing.smooth(smoothing.start_values(arrays.withColumns(weights)))

    def search(arrays, freq, n_iter=50, seed=0):
        del freq, n_iter, seed
        params = F.create_map(*[F.lit(x) for x in ("trend", trend, "alpha", repr(alpha), "beta", repr(beta))])
        return smoothed(arrays).select("series_id", F.lit(0).alias("candidate_id"), params.alias("params"), F.size("z").alias("n"),
                                       F.sqrt(smoothing.residual_variance()).alias("score"), F.lit("ok").alias("status"))

    def predict(best, arrays, steps, freq, alpha=0.05, refit_rows=False):
        rows = smoothed(best.select("series_id", "model").join(arrays, "series_id")).withColumns(
            {"ahead": smoothing.forecast_array(steps), "offset": F.lit(0)})
        lower, upper = smoothing.bands(F.col("ahead"), smoothing.residual_variance(), smoothing.variance_factors(steps), alpha)
        return rows.withColumns({"lower": lower, "upper": upper})
    return Family(search, predict, True, repr((trend, alpha, beta)))


def _bayes() -> Family:
    """Bayesian regression: nothing to search, scales are learned in the fit."""
    def search(arrays, freq, n_iter=50, seed=0):
        del n_iter, seed
        fitted = bayes.bayes_fit(_rows(arrays), freq)
        return fitted.select("series_id", "model", F.lit(0).alias("candidate_id"), "params", "coef", "n",
                             F.sqrt("sigma2").alias("score"), F.lit("ok").alias("status"))

    def predict(best, arrays, steps, freq, alpha=0.05, refit_rows=False):
        if refit_rows:
            best = search(arrays, freq)
        rows = best.select("series_id", "model", "params", "coef", "score").join(arrays, "series_id")
        rows = rows.withColumns({"n": F.size("z"), "offset": F.lit(0)})
        reach = normal_quantile(alpha) * F.col("score")
        return rows.withColumns({
            "fitted": F.transform("ds", lambda _, i: bayes.mean_at(F.col("coef"), i)),
            "ahead": bayes.forecast_array(steps)}).withColumns({
                "lower": F.transform("ahead", lambda f: f - reach), "upper": F.transform("ahead", lambda f: f + reach)})
    return Family(search, predict, False)


FAMILIES: dict[str, Family] = {
    "ar": _ar(),
    "ar1": _ar(fixed=True),
    "hw_simple": _fixed_smoothing("none", 1 / 3, 0.0),
    "hw_trend": _fixed_smoothing("add", 1 / 3, 1 / 30),
    "bayes": _bayes(),
    "ets": _smoothing("ets", smoothing.ets_grid),
    "hw": _smoothing("hw", smoothing.hw_grid),
    "arima": _array_model("arima", arima.arima_grid, arima.fit_arima, arima.apply_arima),
    "prophet": _validated_model("prophet", decomposable.GRID,
                                lambda freq: (decomposable.score_fold, decomposable.fit, decomposable.apply),
                                1, draw_grid, True),
    "svr": _validated_model("svr", learners.SVR_GRID, lambda freq: learners.make("svr", lags_of(freq)), 3,
                            sample_candidates, False),
    "mlp": _validated_model("mlp", learners.MLP_GRID, lambda freq: learners.make("mlp", lags_of(freq)), 3,
                            sample_candidates, False),
    "ssm": _array_model("ssm", lambda freq: statespace.SIGMA_GRID, statespace.fit_structural,
                        statespace.apply_structural, _grid_only),
}


def register_forecaster(name: str, search, predict, has_bands: bool = False, version: str = "") -> None:
    """Add a family; ``run_experiment(families=[name])`` can then use it.

    Fits are stored under the family's name and ``version``: change the version
    when the search changes.
    """
    FAMILIES[name] = Family(search, predict, has_bands, version)


def register_simple_forecaster(name: str, fit_one, apply_one, grid: dict[str, list[str]]) -> None:
    """A family from two functions on one series, run as Arrow batches.

    ``fit_one(values, params) -> (coef, score, status)``;
    ``apply_one(values, ds, params, coef, future) -> (fits, forecasts, stderr)``.
    """
    FAMILIES[name] = _array_model(name, lambda freq: grid, fit_one, apply_one, _grid_only)
