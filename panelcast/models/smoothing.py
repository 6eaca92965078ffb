"""Exponential smoothing: one recursion for ETS and Holt-Winters.

State: level ``l``, trend ``b``, one seasonal value per position of the cycle.
With error ``e`` the update in error-correction form is

    level  = base + alpha * e1        base = l, l + phi b, or l * b**phi
    trend  = phi b + beta * e1        (b**phi + beta * e1 / l when multiplicative)
    season = s + gamma * e            (s + gamma * e / base when multiplicative)

where ``e1`` is ``e``, divided by the seasonal value when that multiplies.
Holt-Winters' own trend weight is ``beta / alpha``.  Fitted values, forecasts
and bands are JVM expressions; the search in ``fit_smoothing`` runs
vectorised over many parameter sets per series inside Spark tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from panelcast.functions.calendar import season_periods_of
from panelcast.functions.recursions import damped_sum, let, normal_quantile, scan, stepped
from panelcast.operators.search import fit_candidates, grid_params, sampled_numbers

STATE_COLUMNS = ["trend", "seasonal", "alpha", "beta", "gamma", "phi", "l0", "b0", "s0"]


# --- start values and recursion as expressions -----------------------------

def start_values(rows: DataFrame, season: int | None = None, seasonal: str = "none",
                 value: str = "z") -> DataFrame:
    """Legacy start values for rows with a ``trend`` column.

    Averages over the first two cycles when there is a season, else the first
    value and the first difference (or ratio).
    """
    z, trend = F.col(value), F.col("trend")
    mean = lambda part, n: F.aggregate(part, F.lit(0.0), lambda a, v: a + v) / n
    if season and seasonal != "none":
        l0, second = mean(F.slice(z, 1, season), season), mean(F.slice(z, season + 1, season), season)
        rise, ratio = (second - l0) / season, F.pow(second / F.when(l0 != 0, l0), 1.0 / season)
        swing = (lambda v: v - l0) if seasonal == "add" else (lambda v: v / l0)
        s0 = F.transform(F.slice(z, 1, season), swing)
    else:
        l0, second = F.get(z, F.lit(0)), F.get(z, F.lit(1))
        rise, ratio = second - l0, second / F.when(l0 != 0, l0)
        s0 = F.array().cast("array<double>")
    b0 = F.when(trend == "add", rise).when(trend == "mul", ratio).otherwise(F.lit(0.0))
    return rows.withColumns({"seasonal": F.lit(seasonal), "l0": l0, "b0": b0, "s0": s0})


def _base(level: Column, trend: Column, weight: Column) -> Column:
    kind = F.col("trend")
    return (F.when(kind == "add", level + weight * trend)
            .when(kind == "mul", level * F.pow(trend, weight)).otherwise(level))


def _with_season(base: Column, swing: Column) -> Column:
    kind = F.col("seasonal")
    return F.when(kind == "add", base + swing).when(kind == "mul", base * swing).otherwise(base)


def _step(state: Column, y: Column) -> Column:
    alpha, beta, gamma, phi = (F.col(c) for c in ("alpha", "beta", "gamma", "phi"))
    multiplies = F.col("seasonal") == "mul"
    level, trend, seas = state["l"], state["b"], state["s"]

    def correct(p: Column) -> Column:
        """Update from the one-step prediction ``p`` (base, swing, yhat)."""
        e = y - p["yhat"]
        e1 = F.when(multiplies, e / p["swing"]).otherwise(e)
        next_trend = (F.when(F.col("trend") == "add", phi * trend + beta * e1)
                      .when(F.col("trend") == "mul", F.pow(trend, phi) + beta * e1 / level).otherwise(trend))
        rotated = F.when(F.size(seas) > 0, F.concat(F.slice(seas, 2, F.size(seas)), F.array(
            p["swing"] + gamma * F.when(multiplies, e / p["base"]).otherwise(e)))).otherwise(seas)
        following = F.struct((p["base"] + alpha * e1).alias("l"), next_trend.alias("b"), rotated.alias("s"))
        return stepped(following, p["yhat"])

    swing = F.when(F.size(seas) == 0, F.lit(0.0)).otherwise(F.element_at(seas, 1))
    parts = F.struct(_base(level, trend, phi).alias("base"), swing.alias("swing"))
    return let(parts, lambda b: let(
        F.struct(b["base"].alias("base"), b["swing"].alias("swing"),
                 _with_season(b["base"], b["swing"]).alias("yhat")), correct))


def smooth(rows: DataFrame, value: str = "z") -> DataFrame:
    """Run the recursion on each row ``(z array, STATE_COLUMNS)``.

    Adds ``fitted`` (one-step predictions), ``level``, ``slope`` and ``swings``
    (the state after the last observation, next seasonal value first).
    """
    zero = F.struct(F.col("l0").alias("l"), F.col("b0").alias("b"), F.col("s0").alias("s"))
    run = rows.withColumn("_run", scan(F.col(value), zero, _step, "double"))
    return run.withColumns({
        "fitted": F.col("_run.out"), "level": F.col("_run.state.l"),
        "slope": F.col("_run.state.b"), "swings": F.col("_run.state.s")}).drop("_run")


def forecast_array(steps: int) -> Column:
    """Point forecasts 1..steps from the columns left by ``smooth``."""
    def at(h: Column) -> Column:
        seas = F.col("swings")
        swing = F.when(F.col("seasonal") == "none", F.lit(0.0)).otherwise(
            F.element_at(seas, (F.pmod(h - 1, F.greatest(F.size(seas), F.lit(1))) + 1).cast("int")))
        return _with_season(_base(F.col("level"), F.col("slope"), damped_sum(F.col("phi"), h)), swing)
    return F.transform(F.sequence(F.lit(1), F.lit(steps)), at)


def variance_factors(steps: int) -> Column:
    """Forecast variance over the one-step variance, for additive error.

    ``1 + sum of c_j^2`` with ``c_j = alpha + beta * (phi + .. + phi^j)``, plus
    gamma at whole cycles.  For multiplicative error it is applied to the
    relative error, an approximation.
    """
    def weight(j: Column) -> Column:
        whole_cycle = (F.col("seasonal") != "none") & (F.pmod(j, F.greatest(F.size("s0"), F.lit(1))) == 0)
        trend_part = F.when(F.col("trend") == "none", F.lit(0.0)).otherwise(
            F.col("beta") * damped_sum(F.col("phi"), j))
        c = F.col("alpha") + trend_part + F.when(whole_cycle, F.col("gamma")).otherwise(F.lit(0.0))
        return c * c
    out = scan(F.sequence(F.lit(1), F.lit(steps)), F.lit(1.0),
               lambda acc, j: stepped(acc + weight(j), acc), "double")
    return out["out"]


def bands(forecast: Column, sigma2: Column, factors: Column, alpha: float = 0.05) -> tuple[Column, Column]:
    # Bound before the lambda: an expression inside it is evaluated for every step.
    reach = let(F.struct(sigma2.alias("s"), factors.alias("f")), lambda b: F.zip_with(forecast, b["f"], lambda f, v: F.struct(
        f.alias("f"), (F.lit(normal_quantile(alpha)) * F.sqrt(b["s"] * v)).alias("r"))))
    return F.transform(reach, lambda p: p["f"] - p["r"]), F.transform(reach, lambda p: p["f"] + p["r"])


def residual_variance(value: str = "z") -> Column:
    """Mean squared one-step error of a row handled by ``smooth``."""
    squares = F.zip_with(F.col(value), F.col("fitted"), lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0.0), lambda a, v: a + v) / F.size(value)


# --- candidates and search ---------------------------------------------------

def ets_grid(freq: str) -> dict[str, list[str]]:
    return {"error": ["add", "mul"], "trend": ["none", "add", "mul"], "seasonal": ["none", "add", "mul"],
            "seasonal_periods": [str(s) for s in season_periods_of(freq)], "damped_trend": ["true", "false"]}


def hw_grid(freq: str) -> dict[str, list[str]]:
    return {"trend": ["none", "add", "mul"], "damped_trend": ["true", "false"],
            "seasonal": ["none", "add", "mul"], "seasonal_periods": [str(s) for s in season_periods_of(freq)],
            "initialization_method": ["estimated", "heuristic", "legacy-heuristic"]}


def _one_step(y, weights, start, season, trend, seasonal):
    """Fitted values (n x B) for B parameter sets or start vectors at once."""
    alpha, beta, gamma, phi = weights
    level, slope = start[0].copy(), start[1].copy()
    swings = start[2:].copy()
    out = np.empty((len(y), len(level)))
    for t in range(len(y)):
        base = level + phi * slope if trend == "add" else level * slope ** phi if trend == "mul" else level
        i = t % season
        swing = swings[i]
        yhat = base + swing if seasonal == "add" else base * swing if seasonal == "mul" else base
        out[t] = yhat
        e = y[t] - yhat
        e1 = e / swing if seasonal == "mul" else e
        if trend == "add":
            slope = phi * slope + beta * e1
        elif trend == "mul":
            slope = slope ** phi + beta * e1 / level
        level = base + alpha * e1
        if seasonal != "none":
            swings[i] = swing + gamma * (e / base if seasonal == "mul" else e)
    return out


def _legacy_start(y, season, trend, seasonal):
    if seasonal == "none":
        slope = (y[1] / y[0] if trend == "mul" else y[1] - y[0]) if trend != "none" else 0.0
        return np.r_[y[0], slope, np.zeros(1)]
    first, second = y[:season].mean(), y[season:2 * season].mean()
    slope = 0.0
    if trend == "add":
        slope = (second - first) / season
    elif trend == "mul":
        slope = (second / first) ** (1.0 / season)
    return np.r_[first, slope, y[:season] - first if seasonal == "add" else y[:season] / first]


def _regression_start(y, season, trend, seasonal):
    """Cycle averages of the detrended start, then a line through ten points."""
    if seasonal == "none":
        body, swings = y, np.zeros(1)
    else:
        cycles = y[:(min(len(y) // season, 5)) * season].reshape(-1, season)
        centre = cycles.mean(axis=1, keepdims=True)
        swings = (cycles - centre if seasonal == "add" else cycles / centre).mean(axis=0)
        tiled = np.resize(swings, len(y))
        body = y - tiled if seasonal == "add" else y / tiled
    t = np.arange(1, min(10, len(body)) + 1)
    slope, level = np.polyfit(t, body[:len(t)], 1)
    if trend == "none":
        return np.r_[body[:len(t)].mean(), 0.0, swings]
    return np.r_[level, slope if trend == "add" else max(1 + slope / level, 1e-3), swings]


def _weights_grid(trend, seasonal, damped, centre=None, width=None):
    """Parameter sets to try: a coarse grid, or a finer one around ``centre``."""
    coarse = {
        "alpha": [.02, .1, .3, .6, .9], "ratio": [.02, .1, .4] if trend != "none" else [0.0],
        "season": [.01, .1, .4, .8] if seasonal != "none" else [0.0],
        "phi": ([.85, .95, .98] if damped else [1.0])}
    if centre is not None:
        for name, value, low, high in zip(coarse, centre, (.001, .001, .001, .8), (.999, .999, .999, .995)):
            if len(coarse[name]) > 1:
                coarse[name] = sorted(set(np.clip([value * (1 - width), value, value + width * (1 - value)], low, high)))
    mesh = np.meshgrid(*coarse.values(), indexing="ij")
    return [m.ravel() for m in mesh]


def fit_smoothing(y: np.ndarray, params: dict) -> tuple[np.ndarray, float, str]:
    """Best weights and start values of one series for one candidate.

    For additive models the one-step predictions are linear in the start
    values, so "estimated" starts are an exact least-squares solution given
    the weights.  Returns ``(coef, rmse, status)``.
    """
    if not len(y):
        return np.array([]), np.nan, "failed: does not apply to this series"
    trend, seasonal = params["trend"], params["seasonal"]
    season = int(params["seasonal_periods"]) if seasonal != "none" else 1
    damped = params["damped_trend"] == "true"
    multiplies = "mul" in (trend, seasonal, params.get("error", "add"))
    if damped and trend == "none":
        return np.array([]), np.nan, "failed: damped trend without trend"
    if multiplies and y.min() <= 0:
        return np.array([]), np.nan, "failed: multiplicative model needs positive values"
    if seasonal != "none" and (season < 2 or len(y) < 2 * season):
        return np.array([]), np.nan, "failed: fewer than two seasonal cycles"
    if len(y) < 10:
        return np.array([]), np.nan, "failed: fewer than ten rows"
    method = params.get("initialization_method", "estimated")
    linear = method == "estimated" and trend != "mul" and seasonal != "mul"
    start = (_legacy_start if method == "legacy-heuristic" else _regression_start)(y, season, trend, seasonal)

    def evaluate(grid):
        alpha, ratio, share, phi = grid
        weights = (alpha, alpha * ratio, share * (1 - alpha), phi)
        if not linear:
            runs = _one_step(y, weights, np.repeat(start[:, None], len(alpha), 1), season, trend, seasonal)
            sse = ((y[:, None] - runs) ** 2).sum(axis=0)
            i = int(np.nanargmin(np.where(np.isfinite(sse), sse, np.inf)))
            return sse[i], [g[i] for g in grid], [w[i] for w in weights], start
        free = [0] + ([1] if trend != "none" else []) + (list(range(2, 2 + season)) if seasonal != "none" else [])
        basis = np.zeros((len(start), len(free) + 1))
        basis[free, np.arange(1, len(free) + 1)] = 1.0
        b, k = len(alpha), basis.shape[1]
        wide = tuple(np.repeat(w, k) for w in weights)
        runs = _one_step(y, wide, np.tile(basis, b), season, trend, seasonal).reshape(len(y), b, k)
        zero = runs[:, :, 0]
        best = (np.inf, None, None, None)
        # Responses to each start value; a light ridge fixes the level/season tie.
        design = (runs[:, :, 1:] - zero[:, :, None]).transpose(1, 0, 2)
        gram = design.transpose(0, 2, 1) @ design + 1e-6 * np.eye(len(free))
        target = (y[:, None] - zero).T[:, :, None]
        solved = np.linalg.solve(gram, design.transpose(0, 2, 1) @ target)[:, :, 0]
        sse = ((target[:, :, 0] - np.einsum("bnk,bk->bn", design, solved)) ** 2).sum(axis=1)
        i = int(np.nanargmin(np.where(np.isfinite(sse), sse, np.inf)))
        x0 = np.zeros(len(start))
        x0[free] = solved[i]
        return sse[i], [g[i] for g in grid], [w[i] for w in weights], x0

    best = evaluate(_weights_grid(trend, seasonal, damped))
    for width in (.5, .2):
        finer = evaluate(_weights_grid(trend, seasonal, damped, best[1], width))
        best = min(best, finer, key=lambda r: r[0])
    sse, _, weights, x0 = best
    if not np.isfinite(sse):
        return np.array([]), np.nan, "failed: diverged"
    tail = x0[2:] if seasonal != "none" else []
    return np.r_[weights, x0[:2], tail], float(np.sqrt(sse / len(y))), "ok"


def unpack(fitted: DataFrame) -> DataFrame:
    """Model rows ``(params, coef)`` into the columns ``smooth`` needs."""
    coef = F.col("coef")
    return fitted.withColumns({
        "trend": F.col("params")["trend"], "seasonal": F.col("params")["seasonal"],
        "alpha": coef[0], "beta": coef[1], "gamma": coef[2], "phi": coef[3], "l0": coef[4], "b0": coef[5],
        "s0": F.slice(coef, 7, F.greatest(F.size(coef) - 6, F.lit(0)))})


def search(arrays: DataFrame, model: str, grid: dict[str, list[str]], n_iter: int = 50,
           seed: int = 0) -> DataFrame:
    """``n_iter`` fitted candidates per series, from three times as many different draws.

    Draws are sorted out inside the row of the series, before anything is
    multiplied or moved.  One that cannot apply to a series travels without
    its values and keeps a failure status.
    """
    z, low, n = F.col("z"), F.array_min("z"), F.size("z")
    draws = F.transform(sampled_numbers(model, grid, 3 * n_iter, seed), lambda i: F.struct(
        i.alias("id"), grid_params(i, grid).alias("params")))
    rows = arrays.select("series_id", "z").withColumn("_draws", draws)
    usable = F.slice(F.filter("_draws", lambda c: applies(c["params"], low, n)), 1, n_iter)
    unusable = F.filter("_draws", lambda c: ~applies(c["params"], low, n))
    tag = lambda ok: lambda c: F.struct(c["id"].alias("id"), c["params"].alias("params"), F.lit(ok).alias("ok"))
    chosen = F.explode(F.concat(F.transform(usable, tag(True)), F.transform(unusable, tag(False)))).alias("c")
    return fit_candidates(rows.select("series_id", "z", chosen).select(
        "series_id", F.lit(model).alias("model"), F.col("c.id").alias("candidate_id"), F.col("c.params").alias("params"),
        F.when(F.col("c.ok"), z).otherwise(F.slice(z, 1, 0)).alias("z")), fit_smoothing)


def applies(p: Column, low: Column, n: Column) -> Column:
    """Whether parameters ``p`` suit a series of minimum ``low`` and length ``n``."""
    multiplies = (p["trend"] == "mul") | (p["seasonal"] == "mul") | F.coalesce(p["error"] == "mul", F.lit(False))
    return ~((p["damped_trend"] == "true") & (p["trend"] == "none")) & ~(multiplies & (low <= 0)) & (
        (p["seasonal"] == "none") | (n >= 2 * p["seasonal_periods"].cast("int")))


def predict(best: DataFrame, arrays: DataFrame, steps: int, alpha: float = 0.05) -> DataFrame:
    """Fits, forecasts and bands of fitted rows, as arrays on the scaled values."""
    rows = smooth(unpack(best.join(arrays, "series_id"))).withColumn("ahead", forecast_array(steps))
    relative = F.coalesce(F.col("params")["error"], F.lit("add")) == "mul"
    flat = F.transform("ahead", lambda f: F.when(relative, f * f).otherwise(F.lit(1.0)))
    errors = F.zip_with(F.col("z"), F.col("fitted"),
                        lambda a, f: F.pow((a - f) / F.when(relative, f).otherwise(F.lit(1.0)), 2))
    sigma2 = F.aggregate(errors, F.lit(0.0), lambda a, v: a + v) / F.size("z")
    factors = F.zip_with(variance_factors(steps), flat, lambda v, f: v * f)
    lower, upper = bands(F.col("ahead"), sigma2, factors, alpha)
    return rows.withColumns({"lower": lower, "upper": upper})
