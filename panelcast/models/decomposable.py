"""Decomposable model: piecewise-linear trend and Fourier seasonality.

Ridge regression on a design that depends on dates only; the changepoint
prior is a Laplace one, reached by a few reweighting rounds on the same cross
products.  One (series, candidate) row at a time, spread by Spark.
"""

from __future__ import annotations

import numpy as np

GRID = {
    "changepoint_prior_scale": ["0.01", "0.1", "0.5"], "seasonality_prior_scale": ["0.1", "1.0", "10.0"],
    "holidays_prior_scale": ["0.1", "1.0"], "seasonality_mode": ["additive", "multiplicative"],
    "changepoint_range": ["0.8"], "n_changepoints": ["20", "30"]}

YEAR, WEEK = 365.25, 7.0


def _layout(ds):
    """Origin, span and the (period, order) pairs the dates can support."""
    days = ds.astype("datetime64[D]").astype(float)
    span = max(days[-1] - days[0], 1.0)
    gap = np.median(np.diff(days)) if len(days) > 1 else 1.0
    waves = [(YEAR, 10)] if span >= 2 * YEAR else []
    if gap < 7 and span >= 2 * WEEK:
        waves.append((WEEK, 3))
    return days[0], span, waves


def _design(ds, layout, n_changes, share):
    origin, span, waves = layout
    days = ds.astype("datetime64[D]").astype(float)
    t = (days - origin) / span
    knots = np.linspace(0, share, n_changes + 1)[1:]
    trend = np.column_stack([np.ones_like(t), t, np.maximum(t[:, None] - knots, 0)])
    angles = [2 * np.pi * j * days / period for period, order in waves for j in range(1, order + 1)]
    season = np.column_stack([f(a) for a in angles for f in (np.cos, np.sin)] or [np.zeros((len(t), 0))])
    return trend, season


def _settings(params):
    return (int(params["n_changepoints"]), float(params["changepoint_range"]),
            float(params["changepoint_prior_scale"]), float(params["seasonality_prior_scale"]),
            params["seasonality_mode"] == "multiplicative")


def _ridge(x, y, penalty, noise):
    return np.linalg.solve(x.T @ x / noise + np.diag(penalty), x.T @ y / noise)


def _solve(z, ds, params, rounds=8):
    n_changes, share, change_scale, season_scale, multiplies = _settings(params)
    layout = _layout(ds)
    trend, season = _design(ds, layout, n_changes, share)
    unit = max(np.abs(z).max(), 1e-9)
    y = z / unit
    k, m = trend.shape[1], season.shape[1]
    noise, delta = max(np.var(np.diff(y)) / 2, 1e-6), np.full(n_changes, change_scale)
    beta = np.zeros(m)
    for _ in range(rounds):
        change = 1 / (change_scale * np.maximum(np.abs(delta), 1e-4))
        loose = np.r_[1 / 25.0, 1 / 25.0, change]
        if multiplies:
            # Season scales the trend: fit each given the other.
            factor = 1 + season @ beta
            a = _ridge(trend * factor[:, None], y, loose, noise)
            level = trend @ a
            beta = _ridge(season * level[:, None], y - level, np.full(m, 1 / season_scale ** 2), noise)
            yhat = level * (1 + season @ beta)
        else:
            both = _ridge(np.hstack([trend, season]), y, np.r_[loose, np.full(m, 1 / season_scale ** 2)], noise)
            a, beta = both[:k], both[k:]
            yhat = trend @ a + season @ beta
        delta, noise = a[2:], max(np.mean((y - yhat) ** 2), 1e-8)
    return np.r_[unit, np.sqrt(noise), a, beta], yhat * unit, layout


def _predict(coef, layout, params, ds):
    n_changes, share, _, _, multiplies = _settings(params)
    trend, season = _design(ds, layout, n_changes, share)
    a, beta = coef[2:4 + n_changes], coef[4 + n_changes:]
    level = trend @ a
    return coef[0] * (level * (1 + season @ beta) if multiplies else level + season @ beta)


def score_fold(z, ds, params, fold, folds):
    """Squared error on the last fifth after fitting the first four fifths."""
    del fold, folds
    cut = int(0.8 * len(z))
    if cut < 20:
        return np.nan
    coef, _, layout = _solve(z[:cut], ds[:cut], params)
    return np.mean((z[cut:] - _predict(coef, layout, params, ds[cut:])) ** 2)


def fit(z, ds, params):
    coef, _, _ = _solve(z, ds, params)
    return coef


def apply(z, ds, params, coef, future):
    """Fits, forecasts and standard errors.

    The error grows by the variance of future trend changes: changes as
    frequent and as large as past ones, integrated over the time ahead.
    """
    layout = _layout(ds)
    n_changes, share, *_ = _settings(params)
    ahead = (future.astype(float) - ds[-1].astype("datetime64[D]").astype(float)) / layout[1]
    size = np.mean(np.abs(coef[4:4 + n_changes])) if n_changes else 0.0
    drift = 2 * size ** 2 * (n_changes / share) * ahead ** 3 / 3
    stderr = coef[0] * np.sqrt(coef[1] ** 2 + drift)
    return _predict(coef, layout, params, ds), _predict(coef, layout, params, future), stderr


