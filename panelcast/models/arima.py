"""Seasonal ARIMA by conditional sum of squares, one (series, candidate) per row.

Differencing, lag polynomials and the damped Gauss-Newton steps are numpy on
one short array; Spark spreads the rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from panelcast.functions.calendar import season_periods_of
from panelcast.operators.grid import by_date


def arima_grid(freq: str) -> dict[str, list[str]]:
    return {"p": list("0123"), "d": list("012"), "q": list("0123"), "P": list("012"), "D": list("01"),
            "Q": list("012"), "s": [str(s) for s in season_periods_of(freq)], "trend": ["n", "c", "t", "ct"],
            "seasonal": ["true", "false"]}


def seasonal_difference(panel: DataFrame, d: int, D: int, s: int, value: str = "z",
                        out: str = "w") -> DataFrame:
    """``d`` ordinary and ``D`` seasonal differences; incomplete rows dropped."""
    rows = panel.withColumn(out, F.col(value))
    for lag in [1] * d + [s] * D:
        rows = rows.withColumn(out, F.col(out) - F.lag(out, lag).over(by_date()))
    return rows.where(F.col(out).isNotNull())


def orders(params: dict) -> tuple[tuple[int, ...], str]:
    p, d, q, P, D, Q, s = (int(params.get(k, 0)) for k in ("p", "d", "q", "P", "D", "Q", "s"))
    if params.get("seasonal", "true") == "false":
        P = D = Q = 0
    return (p, d, q, P, D, Q, max(s, 1)), params.get("trend", "n")


def _difference(z, d, D, s):
    for lag in [1] * d + [s] * D:
        z = z[lag:] - z[:-lag]
    return z


def _polynomials(theta, order, k_trend):
    """Lag polynomials ``1 - phi B ..`` and ``1 + theta B ..`` of a vector."""
    p, _, q, P, _, Q, s = order
    parts = np.split(theta[k_trend:], np.cumsum([p, q, P]))
    ar, ma = np.r_[1.0, -parts[0]], np.r_[1.0, parts[1]]
    season_ar, season_ma = np.zeros(P * s + 1), np.zeros(Q * s + 1)
    season_ar[0] = season_ma[0] = 1.0
    season_ar[s::s], season_ma[s::s] = -parts[2], parts[3]
    return np.convolve(ar, season_ar), np.convolve(ma, season_ma)


def _trend_columns(n, trend):
    t = np.arange(1, n + 1)
    return np.column_stack([c for flag, c in (("c", np.ones(n)), ("t", t / 100.0)) if flag in trend] or [np.empty((n, 0))])


def _burn(order):
    """Rows that only start the ordinary lags and are left out of the squared errors.

    One rule for series of all lengths and for all candidates: rows before the
    start count as zeros for the seasonal lags.
    """
    return order[0]


def _residuals(w, thetas, order, trend, burn):
    """Residuals of several parameter vectors at once (n x B).

    The first ``burn`` rows see zeros as their past and hand no shocks on.
    """
    x = _trend_columns(len(w), trend)
    polys = [_polynomials(theta, order, x.shape[1]) for theta in thetas]
    e = np.column_stack([np.convolve(w, a)[:len(w)] - x @ th[:x.shape[1]] for (a, _), th in zip(polys, thetas)])
    ma = np.array([m for _, m in polys])
    lags = np.flatnonzero(np.abs(ma).sum(axis=0))[1:]
    if len(lags):
        weights = ma[:, lags].T
        # Room before the start makes every lag addressable.
        room = lags[-1]
        padded = np.vstack([np.zeros((room + burn, e.shape[1])), e[burn:]])
        for t in range(room + burn, len(padded)):
            padded[t] -= (weights * padded[t - lags]).sum(axis=0)
        e = np.vstack([e[:burn], padded[room + burn:]])
    return e


def _stable(poly) -> bool:
    return len(poly) < 2 or not np.any(poly[1:]) or np.abs(np.roots(poly[:np.flatnonzero(poly)[-1] + 1])).max() < 0.9999


def _inside(theta, order, k_trend):
    """Stationary and invertible, checked on the four short polynomials."""
    p, _, q, P, _, Q, _ = order
    a, b, c, d = np.split(theta[k_trend:], np.cumsum([p, q, P]))
    return all(_stable(np.r_[1.0, sign * part]) for sign, part in ((-1, a), (1, b), (-1, c), (1, d)))


def fit_arima(z: np.ndarray, params: dict, rounds: int = 12) -> tuple[np.ndarray, float, str]:
    """Conditional least squares; ``coef`` is trend, AR, MA, seasonal AR, MA.

    The score is the in-sample error over all rows but the first p.
    """
    order, trend = orders(params)
    p, d, q, P, D, Q, s = order
    w = _difference(z, d, D, s)
    k_trend = _trend_columns(2, trend).shape[1]
    k = k_trend + p + q + P + Q
    if len(w) < max(3 * k, 40 if d or D or P or Q else 10) + p:
        return np.array([]), np.nan, "failed: too few rows after differencing"
    theta = np.zeros(k)
    if k_trend:
        theta[:k_trend] = np.linalg.lstsq(_trend_columns(len(w), trend), w, rcond=None)[0]
    burn = _burn(order)
    run = lambda thetas: _residuals(w, thetas, order, trend, burn)[burn:]
    best = run([theta])[:, 0]
    damping, step = 1e-2, 1e-5
    for _ in range(rounds if k else 0):
        moved = run([theta] + [theta + step * unit for unit in np.eye(k)])
        slope = (moved[:, 1:] - moved[:, :1]) / step
        gram, grad = slope.T @ slope, slope.T @ moved[:, 0]
        tries = [theta - np.linalg.solve(gram + lam * (np.diag(np.diag(gram)) + 1e-9 * np.eye(k)), grad)
                 for lam in (damping / 10, damping, damping * 10, damping * 100)]
        tries = [t for t in tries if _inside(t, order, k_trend)]
        if not tries:
            damping *= 100
            if damping > 1e6:
                break
            continue
        sse = (run(tries) ** 2).sum(axis=0)
        i = int(np.nanargmin(np.where(np.isfinite(sse), sse, np.inf)))
        old = (best ** 2).sum()
        if not sse[i] < old:
            damping *= 100
            if damping > 1e6:
                break
            continue
        theta, damping = tries[i], max(damping / 5, 1e-6)
        best = run([theta])[:, 0]
        if old - sse[i] < 1e-7 * old:
            break
    score = float(np.sqrt(np.mean(best ** 2)))
    return theta, score, "ok" if np.isfinite(score) else "failed: diverged"


def apply_arima(z, ds, params, coef, future):
    """Fits of the rows that have their lags, forecasts, and standard errors."""
    del ds
    steps = len(future)
    order, trend = orders(params)
    p, d, q, P, D, Q, s = order
    w = _difference(z, d, D, s)
    k_trend = _trend_columns(2, trend).shape[1]
    burn = _burn(order)
    e = _residuals(w, [coef], order, trend, burn)[:, 0]
    ar, ma = _polynomials(coef, order, k_trend)
    for lag in [1] * d + [s] * D:
        unit = np.zeros(lag + 1)
        unit[0], unit[lag] = 1.0, -1.0
        ar = np.convolve(ar, unit)
    drift = _trend_columns(len(w) + steps, trend)[len(w):] @ coef[:k_trend]
    # Zeros before the start stand for the presample in both recursions.
    room = len(ar) + len(ma)
    past = np.r_[np.zeros(room), z, np.zeros(steps)]
    shocks = np.r_[np.zeros(room + len(z) - len(e) + burn), e[burn:], np.zeros(steps)]
    psi = np.r_[np.zeros(len(ar)), np.zeros(steps)]
    for h in range(steps):
        t = room + len(z) + h
        past[t] = (drift[h] - ar[1:] @ past[t - len(ar) + 1:t][::-1] + ma[1:] @ shocks[t - len(ma) + 1:t][::-1])
        own = ma[h] if h < len(ma) else 0.0
        psi[len(ar) + h] = own - ar[1:] @ psi[h + 1:len(ar) + h][::-1]
    sigma = np.sqrt(np.mean(e[burn:] ** 2))
    return z[len(z) - len(e) + burn:] - e[burn:], past[-steps:], sigma * np.sqrt(np.cumsum(psi[len(ar):] ** 2))
