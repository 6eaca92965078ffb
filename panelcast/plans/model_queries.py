"""Named queries: hyperparameter search and forecasting models."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import replace
from functools import cache

from pyspark.sql import DataFrame, functions as F

from panelcast.functions.recursions import normal_quantile
from panelcast.models import arima, autoregression, bayes, decomposable, learners, registry, smoothing, trees
from panelcast.operators import evaluate, features, scaling, search
from panelcast.plans import experiment
from panelcast.plans.catalog import query
from panelcast.plans.core_queries import rounded
from panelcast.plans.oracle import ALIGNED, SCORES, SMOOTHED, r, with_
from panelcast.plans.prepare import (prepared_panel, regular_panel, simple_smoothers, smoothed_predictions,
                                     to_predictions, train_arrays)
from panelcast.session import materialize, scratch_path, spread
from panelcast.sources import param_store, stores

STEPS = 52


def _train(spark, d, source="supplier") -> DataFrame:
    return prepared_panel(spark, d, source).where("split = 'train'")


def _arrays(spark, d, source="priority") -> DataFrame:
    return materialize(train_arrays(prepared_panel(spark, d, source)), "arrays")


def _best(arrays, name) -> DataFrame:
    draws = experiment.DEFAULT_DRAWS.get(name, experiment.OTHER_DRAWS)
    return materialize(registry.FAMILIES[name].search(arrays, "W-MON", draws, 0), f"best-{name}")


def _predictions(spark, d, name, kind) -> DataFrame:
    arrays = _arrays(spark, d)
    made = registry.FAMILIES[name].predict(_best(arrays, name), arrays, STEPS, "W-MON")
    rows = to_predictions(made).where(F.col("kind") == kind)
    return rows.select("series_id", "model", "ds", "yhat", "lower", "upper")


def params_text(params="params"):
    entries = F.transform(F.map_entries(params), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.array_join(F.array_sort(entries), ";").alias("params")


def _fit_table(spark, d, name):
    return _best(_arrays(spark, d), name).select("series_id", "model", params_text(), F.round("score", 6).alias("score"))


def _register_family(name, fitted=True, interval=True):
    """Fit, fitted, forecast and interval queries of a searched family."""
    query(f"{name}_fit")(lambda spark, d: _fit_table(spark, d, name))
    if fitted:
        query(f"{name}_fitted")(lambda spark, d: _predictions(spark, d, name, "fitted").drop("lower", "upper"))
    query(f"{name}_forecast")(lambda spark, d: _predictions(spark, d, name, "forecast").drop("lower", "upper"))
    if interval:
        query(f"{name}_interval")(lambda spark, d: _predictions(spark, d, name, "forecast"))


# --- 2.9 search ---------------------------------------------------------------------

ETS_SQL = """g AS (SELECT series_id, CAST((((e.i * 3 + t.i) * 3 + s.i) * 3 + p.i) * 2 + m.i AS INTEGER) AS candidate_id,
 'damped_trend=' || m.v || ';error=' || e.v || ';seasonal=' || s.v || ';seasonal_periods=' || p.v || ';trend=' || t.v AS params
 FROM (SELECT DISTINCT series_id FROM obs),
 (VALUES (0, 'add'), (1, 'mul')) e(i, v), (VALUES (0, 'none'), (1, 'add'), (2, 'mul')) t(i, v),
 (VALUES (0, 'none'), (1, 'add'), (2, 'mul')) s(i, v), (VALUES (0, '4'), (1, '12'), (2, '52')) p(i, v),
 (VALUES (0, 'true'), (1, 'false')) m(i, v))"""


@query("candidate_grid", with_("supplier", ETS_SQL) + "SELECT series_id, 'ets' AS model, candidate_id, params FROM g")
def _(spark, d):
    series = regular_panel(spark, d).select("series_id").distinct()
    return search.explode_grid(series, "ets", smoothing.ets_grid("W-MON")).withColumn("params", params_text())


def _all_grids():
    return {"ar": autoregression.GRID, "arima": arima.arima_grid("W-MON"), "ets": smoothing.ets_grid("W-MON"),
            "hw": smoothing.hw_grid("W-MON"), "prophet": decomposable.GRID, "gb": trees.GB_GRID, "rf": trees.RF_GRID,
            "svr": learners.SVR_GRID, "mlp": learners.MLP_GRID}


@query("candidate_grid_sizes", with_("supplier") + """SELECT series_id, model, candidates FROM (SELECT DISTINCT series_id FROM obs),
(VALUES ('ar', 40), ('arima', 20736), ('ets', 108), ('hw', 162), ('prophet', 72), ('gb', 32), ('rf', 16), ('svr', 24),
 ('mlp', 12)) v(model, candidates)""")
def _(spark, d):
    sizes = F.create_map(*[x for m, g in _all_grids().items() for x in (F.lit(m), F.lit(search.grid_size(g)))])
    return (regular_panel(spark, d).select("series_id").distinct()
            .select("series_id", F.explode(sizes).alias("model", "candidates")))


def _params_sql(grid: dict[str, list[str]], number: str) -> str:
    """The text of a candidate's parameters, by names; the last name of the grid varies fastest."""
    parts, stride = {}, search.grid_size(grid)
    for name, values in grid.items():
        stride //= len(values)
        listed = ", ".join(f"'{v}'" for v in values)
        parts[name] = f"'{name}=' || ([{listed}])[{number} // {stride} % {len(values)} + 1]"
    return " || ';' || ".join(parts[name] for name in sorted(parts))


def _sampled_sql(model: str, grid: dict[str, list[str]], n_iter: int, seed: int) -> str:
    size = search.grid_size(grid)
    high = max(d for d in range(1, int(size ** 0.5) + 1) if size % d == 0)
    digits, state = (high, size // high), f"SELECT series_id, h, i // {size // high} AS p0, i % {size // high} AS p1 FROM start"
    for k in range(search.FEISTEL_ROUNDS):
        mixed = (f"((p{1 - k % 2} * {search.MIX_DIGIT} + ('0x' || substr(h, {8 * k + 1}, 8))::BIGINT * {search.MIX_KEY} + {k})"
                 f" % {search.MIX_PRIME}) // 65536")
        turned = f"(p{k % 2} + {mixed}) % {digits[k % 2]} AS p{k % 2}"
        state = f"SELECT series_id, h, {turned}, p{1 - k % 2} FROM ({state})"
    return f"""SELECT series_id, '{model}' AS model, CAST(c AS INTEGER) AS candidate_id, {_params_sql(grid, 'c')} AS params FROM (
 WITH start AS (SELECT series_id, sha256(series_id || '|{model}|{seed}') AS h, unnest(range({min(n_iter, size)})) AS i
  FROM (SELECT DISTINCT series_id FROM obs)) SELECT series_id, p0 * {digits[1]} + p1 AS c FROM ({state}))"""


@query("sample_candidates", with_("supplier") + _sampled_sql("arima", arima.arima_grid("W-MON"), 50, 7) + " UNION ALL "
       + _sampled_sql("svr", learners.SVR_GRID, 20, 7))
def _(spark, d):
    """50 of 20,736 candidates and 20 of 24, without replacement."""
    series = materialize(regular_panel(spark, d).select("series_id").distinct(), "series")
    drawn = search.sample_candidates(series, "arima", arima.arima_grid("W-MON"), 50, seed=7)
    picked = search.sample_candidates(series, "svr", learners.SVR_GRID, 20, seed=7)
    return drawn.unionByName(picked).withColumn("params", params_text())


# Simple smoothing with five fixed weights: candidates whose fits have exact SQL.
GRID_RUN = """weights AS (SELECT CAST(i AS INTEGER) AS candidate_id, CAST(i + 1 AS DOUBLE) / 7 AS a FROM range(5) x(i)),
train AS (SELECT series_id, ds, z, t, n - 52 AS n FROM split WHERE split = 'train'),
run AS (SELECT x.series_id, w.candidate_id, w.a, CAST(0 AS BIGINT) AS t, x.z AS l, CAST(NULL AS DOUBLE) AS fit
  FROM train x CROSS JOIN weights w WHERE x.t = 0
  UNION ALL SELECT k.series_id, k.candidate_id, k.a, k.t + 1, k.l + k.a * (x.z - k.l), k.l
  FROM run k JOIN train x ON x.series_id = k.series_id AND x.t = k.t),
fits AS (SELECT k.series_id, k.candidate_id, x.ds, x.t, x.n, x.z, k.fit AS zhat FROM run k
  JOIN train x ON x.series_id = k.series_id AND x.t = k.t - 1 WHERE k.t > 0)"""


def _weight_fits(spark, d) -> DataFrame:
    """Fits of level-only smoothing for five weights: series, candidate, ds."""
    rows = smoothing.start_values(train_arrays(prepared_panel(spark, d)).withColumn("trend", F.lit("none")))
    ids = F.explode(F.sequence(F.lit(0), F.lit(4))).alias("candidate_id")
    rows = rows.select("*", ids).withColumns({
        "alpha": (F.col("candidate_id") + 1).cast("double") / 7, "beta": F.lit(0.0), "gamma": F.lit(0.0),
        "phi": F.lit(1.0)})
    out = smoothing.smooth(rows)
    return out.select("series_id", "candidate_id", F.posexplode(F.arrays_zip("ds", "z", "fitted")).alias("t", "p")).select(
        "series_id", "candidate_id", "t", "p.ds", "p.z", F.col("p.fitted").alias("zhat"))


@query("score_insample_rmse", with_("supplier", GRID_RUN, recursive=True) + """SELECT series_id, candidate_id,
round(sqrt(avg((z - zhat) * (z - zhat))), 6) AS score, count(*) AS n FROM fits GROUP BY 1, 2""")
def _(spark, d):
    return rounded(search.score_insample_rmse(_weight_fits(spark, d)), 6, "score")


@query("score_holdout_rmse", with_("supplier", GRID_RUN, recursive=True) + """SELECT series_id, candidate_id,
round(sqrt(avg(CASE WHEN t >= floor(n * 0.8) THEN (z - zhat) * (z - zhat) END)), 6) AS score FROM fits GROUP BY 1, 2""")
def _(spark, d):
    fits = _weight_fits(spark, d)
    flags = search.holdout_flag(_train(spark, d)).select("series_id", "ds", "is_train")
    return rounded(search.score_holdout_rmse(fits.join(flags, ["series_id", "ds"])), 6, "score")


@query("kfold_assignment", with_("supplier") + """SELECT series_id, ds, CAST(CASE WHEN t < (n % 3) * (n // 3 + 1)
 THEN t // (n // 3 + 1) ELSE n % 3 + (t - (n % 3) * (n // 3 + 1)) // (n // 3) END AS INTEGER) AS fold FROM scaled""")
def _(spark, d):
    return search.kfold(regular_panel(spark, d)).select("series_id", "ds", "fold")


BLOCKS_SQL = """pairs AS (SELECT series_id, z, t, lag(z) OVER (PARTITION BY series_id ORDER BY ds) AS x FROM split WHERE split = 'train'),
placed AS (SELECT series_id, z, x, row_number() OVER (PARTITION BY series_id ORDER BY t) - 1 AS i,
  count(*) OVER (PARTITION BY series_id) AS n FROM pairs WHERE x IS NOT NULL),
blocks AS (SELECT series_id, z, x, CASE WHEN i < (n % 3) * (n // 3 + 1) THEN i // (n // 3 + 1)
  ELSE n % 3 + (i - (n % 3) * (n // 3 + 1)) // (n // 3) END AS block FROM placed),
fits AS (SELECT b.series_id, f, regr_slope(z, x) AS phi, regr_intercept(z, x) AS c, sum(z * x) / sum(x * x) AS ratio
  FROM blocks b, range(3) r(f) WHERE {train} GROUP BY 1, 2),
errors AS (SELECT b.series_id, f, avg((z - c - phi * x) * (z - c - phi * x)) AS with_c, avg((z - ratio * x) * (z - ratio * x)) AS without
  FROM blocks b JOIN fits ON fits.series_id = b.series_id AND f = block GROUP BY 1, 2)"""
BLOCKS_OUT = f"""SELECT series_id, 0 AS candidate_id, 'lags=1;trend=c' AS params, {r('avg(with_c)')} AS score FROM errors GROUP BY 1
UNION ALL SELECT series_id, 1, 'lags=1;trend=n', {r('avg(without)')} FROM errors GROUP BY 1"""


def _block_scores(spark, d, rolling):
    sums = autoregression.block_sums(_train(spark, d), lags=1)
    scored = autoregression.score_blocks(sums, [{"lags": "1", "trend": "c"}, {"lags": "1", "trend": "n"}], rolling)
    return scored.select("series_id", "candidate_id", params_text(), F.round("score", 6).alias("score"))


@query("score_kfold_mse", with_("supplier", BLOCKS_SQL.format(train="block <> f")) + BLOCKS_OUT)
def _(spark, d):
    return _block_scores(spark, d, rolling=False)


@query("score_rolling_mse", with_("supplier", BLOCKS_SQL.format(train="block < f")) + BLOCKS_OUT)
def _(spark, d):
    return _block_scores(spark, d, rolling=True)


@query("information_criteria", with_("supplier", GRID_RUN, recursive=True) + """, s AS (SELECT series_id, candidate_id,
 sum((z - zhat) * (z - zhat)) AS sse, count(*) AS m FROM fits GROUP BY 1, 2)
SELECT series_id, candidate_id, round(m * ln(sse / m) + 4, 5) AS aic, round(m * ln(sse / m) + 2 * ln(m), 5) AS bic,
 round(m * ln(sse / m) + 4 + 2.0 * 2 * 3 / (m - 2 - 1), 5) AS aicc FROM s""")
def _(spark, d):
    sums = _weight_fits(spark, d).groupBy("series_id", "candidate_id").agg(
        F.sum(F.pow(F.col("z") - F.col("zhat"), 2)).alias("sse"), F.count("*").alias("m"))
    criteria = search.information_criteria(F.col("sse"), F.col("m"), F.lit(2))
    return sums.select("series_id", "candidate_id", *[F.round(c, 5).alias(n) for n, c in criteria.items()])


@query("skip_failed_candidates", with_("priority", ETS_SQL) + """, lows AS (SELECT series_id, min(z) AS low, count(*) AS m
 FROM split WHERE split = 'train' GROUP BY 1)
SELECT g.series_id, g.candidate_id, params NOT LIKE '%damped_trend=true%trend=none' AND NOT (params LIKE '%=mul%' AND low <= 0)
 AND (params LIKE '%seasonal=none%' OR m >= 2 * CAST(regexp_extract(params, 'seasonal_periods=([0-9]+)', 1) AS INTEGER)) AS kept
FROM g JOIN lows l ON l.series_id = g.series_id""")
def _(spark, d):
    scored = smoothing.search(_arrays(spark, d), "ets", smoothing.ets_grid("W-MON"), 108)
    kept = search.skip_failed_candidates(scored).select("series_id", "candidate_id", F.lit(True).alias("kept"))
    return (scored.join(kept, ["series_id", "candidate_id"], "left")
            .select("series_id", "candidate_id", F.coalesce("kept", F.lit(False)).alias("kept")))


@query("pick_best_candidate", with_("supplier", GRID_RUN, recursive=True) + """, s AS (SELECT series_id, candidate_id,
 round(sqrt(avg((z - zhat) * (z - zhat))), 6) AS score FROM fits GROUP BY 1, 2)
SELECT series_id, 'ses' AS model, candidate_id, score FROM (SELECT *, row_number() OVER (PARTITION BY series_id
 ORDER BY score, candidate_id) AS k FROM s) WHERE k = 1""")
def _(spark, d):
    scored = rounded(search.score_insample_rmse(_weight_fits(spark, d)), 6, "score").drop("n")
    return search.pick_best_candidate(scored.withColumns({"model": F.lit("ses"), "status": F.lit("ok")})).drop("status")


# --- autoregression: AR(1) with constant has exact SQL ---------------------------------

AR_SQL = """pairs AS (SELECT series_id, z, t, lag(z) OVER (PARTITION BY series_id ORDER BY ds) AS x FROM split WHERE split = 'train'),
fit AS (SELECT series_id, regr_slope(z, x) AS phi, regr_intercept(z, x) AS c FROM pairs WHERE x IS NOT NULL GROUP BY 1),
res AS (SELECT p.series_id, f.phi, f.c, sqrt(avg((z - c - phi * x) * (z - c - phi * x))) AS sigma, count(*) AS n
  FROM pairs p JOIN fit f ON f.series_id = p.series_id WHERE x IS NOT NULL GROUP BY 1, 2, 3)"""
AR_AHEAD = """edge AS (SELECT s.series_id, max(t) AS last_t, max(ds) AS last_ds, max_by(z, t) AS z, any_value(center) AS center,
  any_value(scale) AS scale FROM split s WHERE split = 'train' GROUP BY 1),
ahead AS (SELECT e.series_id, CAST(0 AS BIGINT) AS h, e.z AS m, CAST(0 AS DOUBLE) AS v, CAST(1 AS DOUBLE) AS w FROM edge e
  UNION ALL SELECT a.series_id, a.h + 1, f.c + f.phi * a.m, a.v + a.w * a.w, a.w * f.phi
  FROM ahead a JOIN res f ON f.series_id = a.series_id WHERE a.h < 52)"""


def _ar1(spark, d, source="supplier", twice=True):
    """Training rows and the AR(1) of each series; the rows are written if what follows the fit reads them again."""
    train = _train(spark, d, source)
    train = materialize(train, "train") if twice else train
    return train, autoregression.fit_ar(autoregression.with_fixed(autoregression.moments(train)))


@query("ar_fit", with_("supplier", AR_SQL) + "SELECT series_id, round(c, 6) AS const, round(phi, 6) AS phi, round(sigma, 6) AS sigma, n FROM res")
def _(spark, d):
    _, best = _ar1(spark, d, twice=False)
    return best.select("series_id", F.round(F.col("coef")[0], 6).alias("const"), F.round(F.col("coef")[2], 6).alias("phi"),
                       F.round("score", 6).alias("sigma"), "n")


@query("ar_fitted", with_("supplier", AR_SQL) + f"""SELECT s.series_id, s.ds, {r('f.c + f.phi * p.x')} AS zhat FROM pairs p
JOIN res f ON f.series_id = p.series_id JOIN split s ON s.series_id = p.series_id AND s.t = p.t WHERE p.x IS NOT NULL""")
def _(spark, d):
    out = autoregression.ar_fitted(*_ar1(spark, d))
    return out.select("series_id", "ds", F.round("zhat", 6).alias("zhat"))


@query("ar_forecast", with_("supplier", AR_SQL, AR_AHEAD, recursive=True) + f"""SELECT a.series_id,
CAST(last_ds + INTERVAL (7 * h) DAY AS DATE) AS ds, {r('m * scale + center', 4)} AS yhat
FROM ahead a JOIN edge e ON e.series_id = a.series_id WHERE h > 0""")
def _(spark, d):
    train, best = _ar1(spark, d)
    out = to_predictions(autoregression.predict(best, train_arrays(train), STEPS), fits=False)
    return out.select("series_id", "ds", F.round("yhat", 4).alias("yhat"))


@query("ar_interval", with_("supplier", AR_SQL, AR_AHEAD, recursive=True) + f"""SELECT a.series_id,
CAST(last_ds + INTERVAL (7 * h) DAY AS DATE) AS ds, {r('m * scale + center', 4)} AS yhat,
{r(f'(m - {normal_quantile(.05)!r} * sigma * sqrt(v)) * scale + center', 4)} AS lower,
{r(f'(m + {normal_quantile(.05)!r} * sigma * sqrt(v)) * scale + center', 4)} AS upper
FROM ahead a JOIN edge e ON e.series_id = a.series_id JOIN res f ON f.series_id = a.series_id WHERE h > 0""")
def _(spark, d):
    train, best = _ar1(spark, d)
    out = to_predictions(autoregression.predict(best, train_arrays(train), STEPS), fits=False)
    return rounded(out, 4, "yhat", "lower", "upper").select("series_id", "ds", "yhat", "lower", "upper")


@query("ar_search")
def _(spark, d):
    sums = autoregression.with_candidates(autoregression.moments(_train(spark, d)))
    best = search.pick_best_candidate(autoregression.fit_ar(sums))
    return best.select("series_id", "model", params_text(), F.round("score", 6).alias("score"))


@query("recursive_forecast", with_("supplier", AR_SQL, AR_AHEAD, recursive=True) + f"""SELECT series_id,
CAST(h AS INTEGER) AS step, {r('m')} AS zhat FROM ahead WHERE h > 0""")
def _(spark, d):
    train, best = _ar1(spark, d)
    rows = best.join(train_arrays(train), "series_id")
    ahead = features.recursive_forecast(F.array(F.col("coef")[2]), F.col("coef")[0], [1], STEPS)
    return rows.select("series_id", F.posexplode(ahead).alias("p", "v")).select(
        "series_id", (F.col("p") + 1).alias("step"), F.round("v", 6).alias("zhat"))


# --- exponential smoothing with fixed weights: exact SQL ---------------------------------

HW_BANDS = """sig AS (SELECT r.series_id, r.model, avg((x.z - r.fit) * (x.z - r.fit)) AS s2 FROM run r
 JOIN train x ON x.series_id = r.series_id AND x.t = r.t - 1 WHERE r.fit IS NOT NULL GROUP BY 1, 2),
hs AS (SELECT unnest(generate_series(1, 52)) AS h),
fac AS (SELECT s.model, h.h, 1 + coalesce(sum((s.a + s.b * j.h) * (s.a + s.b * j.h)), 0) AS f FROM spec s CROSS JOIN hs h
  LEFT JOIN hs j ON j.h < h.h GROUP BY 1, 2)"""


@query("hw_fitted", with_("supplier", SMOOTHED, recursive=True) +
       f"SELECT series_id, model, ds, {r('yhat', 4)} AS yhat FROM preds WHERE kind = 'fitted'")
def _(spark, d):
    out = smoothed_predictions(prepared_panel(spark, d)).where("kind = 'fitted'")
    return rounded(out, 4, "yhat").select("series_id", "model", "ds", "yhat")


@query("hw_forecast", with_("supplier", SMOOTHED, recursive=True) +
       f"SELECT series_id, model, ds, {r('yhat', 4)} AS yhat FROM preds WHERE kind = 'forecast'")
def _(spark, d):
    out = smoothed_predictions(prepared_panel(spark, d)).where("kind = 'forecast'")
    return rounded(out, 4, "yhat").select("series_id", "model", "ds", "yhat")


def _fixed_bands(rows):
    out = smoothing.smooth(rows).withColumn("ahead", smoothing.forecast_array(STEPS))
    lower, upper = smoothing.bands(F.col("ahead"), smoothing.residual_variance(), smoothing.variance_factors(STEPS))
    out = to_predictions(out.withColumns({"lower": lower, "upper": upper}), fits=False)
    return rounded(out, 3, "yhat", "lower", "upper").select("series_id", "model", "ds", "yhat", "lower", "upper")


@query("hw_interval", with_("supplier", SMOOTHED, HW_BANDS, recursive=True) + f"""SELECT e.series_id, e.model,
 CAST(b.last + INTERVAL (7 * f.h) DAY AS DATE) AS ds, {r('(e.l + f.h * e.g) * s.scale + s.center', 3)} AS yhat,
 {r(f'(e.l + f.h * e.g - {normal_quantile(.05)!r} * sqrt(g.s2 * f.f)) * s.scale + s.center', 3)} AS lower,
 {r(f'(e.l + f.h * e.g + {normal_quantile(.05)!r} * sqrt(g.s2 * f.f)) * s.scale + s.center', 3)} AS upper
FROM ends e JOIN fac f ON f.model = e.model JOIN sig g ON g.series_id = e.series_id AND g.model = e.model
JOIN stats s ON s.series_id = e.series_id JOIN (SELECT series_id, max(ds) AS last FROM train GROUP BY 1) b ON b.series_id = e.series_id""")
def _(spark, d):
    return _fixed_bands(simple_smoothers(train_arrays(prepared_panel(spark, d))))


# Damped trend and a yearly season, legacy start values.
ETS_RUN = """train AS (SELECT series_id, ds, z, t, center, scale FROM split WHERE split = 'train'),
start AS (SELECT series_id, avg(z) FILTER (WHERE t < 52) AS l0, avg(z) FILTER (WHERE t >= 52 AND t < 104) AS l1,
  list(z ORDER BY t) FILTER (WHERE t < 52) AS zs FROM train GROUP BY 1),
run AS (SELECT series_id, CAST(0 AS BIGINT) AS t, l0 AS l, (l1 - l0) / 52 AS b, list_transform(zs, lambda v: v - l0) AS s,
  CAST(NULL AS DOUBLE) AS fit FROM start
  UNION ALL SELECT series_id, t + 1, base + e / 3, 0.9 * b + e / 30, list_append(s[2:], s[1] + e / 7), base + s[1]
  FROM (SELECT k.series_id, k.t, k.b, k.s, k.l + 0.9 * k.b AS base, x.z - (k.l + 0.9 * k.b + k.s[1]) AS e
        FROM run k JOIN train x ON x.series_id = k.series_id AND x.t = k.t)),
ends AS (SELECT r.* FROM run r JOIN (SELECT series_id, max(t) AS t FROM run GROUP BY 1) m ON m.series_id = r.series_id AND m.t = r.t),
edge AS (SELECT series_id, max(ds) AS last_ds, any_value(center) AS center, any_value(scale) AS scale FROM train GROUP BY 1),
hs AS (SELECT unnest(generate_series(1, 52)) AS h),
damp AS (SELECT a.h, sum(power(0.9, b.h)) AS d FROM hs a JOIN hs b ON b.h <= a.h GROUP BY 1),
points AS (SELECT e.series_id, h.h, e.l + d.d * e.b + e.s[(h.h - 1) % 52 + 1] AS z FROM ends e CROSS JOIN hs h JOIN damp d ON d.h = h.h),
sig AS (SELECT r.series_id, avg((x.z - r.fit) * (x.z - r.fit)) AS s2 FROM run r JOIN train x ON x.series_id = r.series_id AND x.t = r.t - 1
  WHERE r.fit IS NOT NULL GROUP BY 1),
fac AS (SELECT h.h, 1 + coalesce(sum(power(CAST(1 AS DOUBLE) / 3 + j.d / 30, 2)), 0) AS f FROM hs h LEFT JOIN damp j ON j.h < h.h GROUP BY 1)"""


def _fixed_ets(spark, d):
    arrays = train_arrays(prepared_panel(spark, d, "nation")).withColumn("trend", F.lit("add"))
    rows = smoothing.start_values(arrays, 52, "add")
    return rows.withColumns({"model": F.lit("ets"), "alpha": F.lit(1 / 3), "beta": F.lit(1 / 30),
                             "gamma": F.lit(1 / 7), "phi": F.lit(0.9)})


@query("ets_fitted", with_("nation", ETS_RUN, recursive=True) + f"""SELECT r.series_id, x.ds, {r('r.fit * x.scale + x.center', 3)} AS yhat
FROM run r JOIN train x ON x.series_id = r.series_id AND x.t = r.t - 1 WHERE r.fit IS NOT NULL""")
def _(spark, d):
    rows = smoothing.smooth(_fixed_ets(spark, d)).withColumn("ahead", smoothing.forecast_array(1))
    return rounded(to_predictions(rows).where("kind = 'fitted'"), 3, "yhat").select("series_id", "ds", "yhat")


@query("ets_forecast", with_("nation", ETS_RUN, recursive=True) + f"""SELECT p.series_id, CAST(last_ds + INTERVAL (7 * h) DAY AS DATE) AS ds,
{r('p.z * scale + center', 3)} AS yhat FROM points p JOIN edge e ON e.series_id = p.series_id""")
def _(spark, d):
    rows = smoothing.smooth(_fixed_ets(spark, d)).withColumn("ahead", smoothing.forecast_array(STEPS))
    return rounded(to_predictions(rows, fits=False), 3, "yhat").select("series_id", "ds", "yhat")


@query("ets_interval", with_("nation", ETS_RUN, recursive=True) + f"""SELECT p.series_id, 'ets' AS model,
CAST(last_ds + INTERVAL (7 * p.h) DAY AS DATE) AS ds, {r('p.z * scale + center', 3)} AS yhat,
{r(f'(p.z - {normal_quantile(.05)!r} * sqrt(s2 * f)) * scale + center', 3)} AS lower,
{r(f'(p.z + {normal_quantile(.05)!r} * sqrt(s2 * f)) * scale + center', 3)} AS upper
FROM points p JOIN edge e ON e.series_id = p.series_id JOIN sig s ON s.series_id = p.series_id JOIN fac f ON f.h = p.h""")
def _(spark, d):
    return _fixed_bands(_fixed_ets(spark, d))


query("ets_fit")(lambda spark, d: _fit_table(spark, d, "ets"))
query("hw_fit")(lambda spark, d: _fit_table(spark, d, "hw"))
query("ets_search_forecast")(lambda spark, d: _predictions(spark, d, "ets", "forecast"))
query("hw_search_forecast")(lambda spark, d: _predictions(spark, d, "hw", "forecast"))

# --- searched families -------------------------------------------------------------------

_register_family("arima")
_register_family("prophet")
_register_family("svr", interval=False)
_register_family("mlp", interval=False)
_register_family("ssm", interval=False)


def _sarima(spark, d):
    """A fixed seasonal order, no search."""
    order = {"p": "1", "d": "0", "q": "1", "P": "1", "D": "0", "Q": "0", "s": "52", "trend": "c", "seasonal": "true"}
    rows = search.explode_grid(_arrays(spark, d).select("series_id", "z"), "sarima", {k: [v] for k, v in order.items()})
    return search.fit_candidates(rows, arima.fit_arima)


@query("sarima_fit")
def _(spark, d):
    return _sarima(spark, d).select("series_id", "model", params_text(), F.round("score", 6).alias("score"), "coef", "status")


@query("sarima_forecast")
def _(spark, d):
    best = search.skip_failed_candidates(_sarima(spark, d))
    rows = best.select("series_id", "model", "params", "coef").join(_arrays(spark, d), "series_id")
    made = search.apply_rows(rows, arima.apply_arima, STEPS)
    return to_predictions(made, fits=False).select("series_id", "model", "ds", "yhat")


# --- Bayesian regression: fitted and forecast of given coefficients are exact -----------------

@query("bayes_fit")
def _(spark, d):
    return bayes.bayes_fit(_train(spark, d)).select(
        "series_id", "model", F.round(F.col("coef")[0], 5).alias("baseline"), F.round(F.col("coef")[1], 7).alias("trend"),
        F.round("sigma2", 5).alias("sigma2"), F.round("loglik", 3).alias("loglik"), "n")


# Given coefficients: baseline the series' median, slope 1/700, a sine season of length 52.
GIVEN = "CASE WHEN {i} % 52 < 26 THEN CAST(1 AS DOUBLE) / 7 ELSE -CAST(1 AS DOUBLE) / 7 END"
BAYES_SQL = """tr AS (SELECT * FROM split WHERE split = 'train'),
given AS (SELECT series_id, median(z) AS base, count(*) AS n, max(ds) AS last_ds FROM tr GROUP BY 1)"""


def _given(train):
    season = F.transform(F.sequence(F.lit(0), F.lit(51)), lambda i: F.when(i < 26, 1 / 7).otherwise(-1 / 7))
    return train.groupBy("series_id").agg(F.median("z").alias("b"), F.count("*").alias("n"), F.max("ds").alias("last")).select(
        "series_id", F.lit("bayes").alias("model"), F.concat(F.array("b", F.lit(1 / 700)), season).alias("coef"), "n", "last")


@query("bayes_fitted", with_("supplier", BAYES_SQL) + f"""SELECT t.series_id, t.ds,
{r(f"g.base + CAST(1 AS DOUBLE) / 700 * t.t + {GIVEN.format(i='t.t')}")} AS zhat FROM tr t JOIN given g ON g.series_id = t.series_id""")
def _(spark, d):
    train = _train(spark, d)
    return bayes.bayes_fitted(train, _given(train)).select("series_id", "ds", F.round("zhat", 6).alias("zhat"))


@query("bayes_forecast", with_("supplier", BAYES_SQL) + f"""SELECT g.series_id, CAST(h + 1 AS INTEGER) AS step,
{r(f"g.base + CAST(1 AS DOUBLE) / 700 * (n + h) + {GIVEN.format(i='(n + h)')}")} AS zhat
FROM given g, (SELECT unnest(generate_series(0, 51)) AS h)""")
def _(spark, d):
    rows = _given(_train(spark, d)).select("series_id", F.posexplode(bayes.forecast_array(STEPS)).alias("p", "v"))
    return rows.select("series_id", (F.col("p") + 1).alias("step"), F.round("v", 6).alias("zhat"))


# --- trees: one global model -------------------------------------------------------------------

def _tree_features(spark, d, rows=None):
    return trees.feature_table(rows() if rows else _train(spark, d, "priority"))


def _searched_trees(features, family):
    """The best of the default draws, refitted on all rows; searched once for all queries of the session's store."""
    return trees.searched_trees(features, family, experiment.DEFAULT_DRAWS[family])[0]


def _register_trees(family):
    @query(f"{family}_fit")
    def _(spark, d):
        table = _tree_features(spark, d)
        out = trees.trees_fitted(table, _searched_trees(table, family), family)
        return out.groupBy("series_id", "model").agg(F.sqrt(F.avg(F.pow(F.col("z") - F.col("zhat"), 2))).alias("score"))

    @query(f"{family}_fitted")
    def _(spark, d):
        table = _tree_features(spark, d)
        out = trees.trees_fitted(table, _searched_trees(table, family), family)
        return scaling.robust_scale_inverse(out, "zhat").select("series_id", "model", "ds", F.col("zhat").alias("yhat"))

    @query(f"{family}_forecast")
    def _(spark, d):
        # Features and arrays come from the same rows, so the facts are read once for both.
        rows = cache(lambda: spread(materialize(_train(spark, d, "priority"), "train"), "series_id"))
        model = _searched_trees(_tree_features(spark, d, rows), family)
        made = trees.trees_forecast(materialize(train_arrays(rows()), "arrays"), model, family, STEPS)
        return to_predictions(made, fits=False).select("series_id", "model", "ds", "yhat")

    @query(f"{family}_importance")
    def _(spark, d):
        table = _tree_features(spark, d)
        return trees.importance(table, _searched_trees(table, family), family)


_register_trees("gb")
_register_trees("rf")


# --- compositions ----------------------------------------------------------------------------------

# Families whose fits have exact SQL: AR(1), and smoothing of level or level and trend with fixed weights.
EXACT_FAMILIES = ("ar1", "hw_simple", "hw_trend")
AR_PREDS = """arp AS (SELECT p.series_id, 'ar1' AS model, s.ds, 'fitted' AS kind, (f.c + f.phi * p.x) * s.scale + s.center AS yhat
  FROM pairs p JOIN res f USING (series_id) JOIN split s ON s.series_id = p.series_id AND s.t = p.t WHERE p.x IS NOT NULL
  UNION ALL SELECT a.series_id, 'ar1', CAST(last_ds + INTERVAL (7 * h) DAY AS DATE), 'forecast', m * scale + center
  FROM ahead a JOIN edge e USING (series_id) WHERE h > 0)"""
RUN_SQL = (SMOOTHED, AR_SQL, AR_AHEAD, AR_PREDS, ALIGNED.replace("FROM preds p", "FROM (SELECT * FROM preds UNION ALL SELECT * FROM arp) p"),
           SCORES)


def _on_all_rows(*ctes: str) -> list[str]:
    """The same tables over all rows of a series instead of the training rows; their names end in ``_f``."""
    names = "train|first2|run|ends|preds|pairs|fit|res|edge|ahead|sig|fac|hs|spec"
    whole = [re.sub(r"(FROM split(?: s)?) WHERE split = 'train'", r"\1", c) for c in ctes]
    return [re.sub(rf"\b((?:FROM|JOIN)\s+)({names})\b", r"\1\2_f", re.sub(rf"\b({names})( AS \()", r"\1_f\2", c)) for c in whole]


FUTURE_SQL = (*_on_all_rows(SMOOTHED, HW_BANDS, AR_SQL, AR_AHEAD), """won AS (SELECT series_id, model FROM (SELECT *, row_number() OVER
  (PARTITION BY series_id ORDER BY weighted_mape, model) AS k FROM scores WHERE phase = 'testing') WHERE k = 1),
points AS (SELECT e.series_id, e.model, f.h, e.l + f.h * e.g AS z, sqrt(g.s2 * f.f) AS se FROM ends_f e JOIN fac_f f ON f.model = e.model
    JOIN sig_f g ON g.series_id = e.series_id AND g.model = e.model
  UNION ALL SELECT a.series_id, 'ar1', a.h, a.m, f.sigma * sqrt(a.v) FROM ahead_f a JOIN res_f f USING (series_id) WHERE a.h > 0),
""" + f"""future AS (SELECT p.series_id, p.model, p.h, CAST(b.hi + INTERVAL (7 * p.h) DAY AS DATE) AS ds, p.z * s.scale + s.center AS yhat,
  (p.z - {normal_quantile(.05)!r} * p.se) * s.scale + s.center AS lower, (p.z + {normal_quantile(.05)!r} * p.se) * s.scale + s.center AS upper
  FROM points p JOIN won USING (series_id, model) JOIN bounds b USING (series_id) JOIN stats s USING (series_id)),
labelled AS (SELECT *, CASE WHEN (upper - lower) / abs(yhat) < 0.2 THEN 'high' WHEN (upper - lower) / abs(yhat) < 0.4 THEN 'medium'
  ELSE 'low' END AS confidence FROM future),
back AS (SELECT a.series_id, a.ds, a.y, a.yhat FROM aligned a JOIN won USING (series_id, model) WHERE a.kind = 'forecast')""")


def _exact_run(spark, d):
    """The whole experiment; its searches are read from the session's store once an earlier query has done them."""
    return experiment.run_experiment(regular_panel(spark, d), EXACT_FAMILIES)


@query("run_experiment", with_("supplier", *RUN_SQL, recursive=True) + "SELECT * FROM scores")
def _(spark, d):
    return rounded(_exact_run(spark, d).scores, 4, "error_std")


@query("future_forecast_best", with_("supplier", *RUN_SQL, *FUTURE_SQL, recursive=True) + f"""SELECT series_id, model, ds,
{r('yhat', 3)} AS yhat, {r('lower', 3)} AS lower, {r('upper', 3)} AS upper, confidence FROM labelled""")
def _(spark, d):
    out = experiment.future_forecast_best(_exact_run(spark, d))
    return rounded(out, 3, "yhat", "lower", "upper").select("series_id", "model", "ds", "yhat", "lower", "upper", "confidence")


def _back_and_future(spark, d):
    """Hold-out rows of each series' winner, and its forecast past the end with confidence from its bands."""
    run = _exact_run(spark, d)
    run = replace(run, scores=materialize(run.scores, "scores"))  # ranked for both parts
    won = evaluate.best_model(run.scores).select("series_id", F.col("best_model").alias("model"))
    rows = run.predictions.where("kind = 'forecast'").join(won, ["series_id", "model"])
    return evaluate.align_actual_forecast(run.prepared, rows), materialize(experiment.future_forecast_best(run), "future")


@query("export_best_model", with_("supplier", *RUN_SQL, *FUTURE_SQL, recursive=True) + f"""
SELECT series_id, ds AS date, round(y, 2) AS actual, {r("yhat", 3)} AS model_fit, CAST(NULL AS DOUBLE) AS forecast,
  CAST(NULL AS VARCHAR) AS confidence FROM back
UNION ALL SELECT series_id, ds, NULL, NULL, {r("yhat", 3)}, confidence FROM labelled""")
def _(spark, d):
    out = stores.export_best_model(*_back_and_future(spark, d))
    return rounded(rounded(out, 3, "model_fit", "forecast"), 2, "actual")


@query("default_view_window", with_("supplier", *RUN_SQL, *FUTURE_SQL, recursive=True) + """SELECT b.series_id, b.view_start,
 CASE WHEN f.highs = 0 OR f.mediums = 0 THEN f.quarter ELSE f.labelled END AS view_end, f.highs = 0 OR f.mediums = 0 AS limited_confidence
 FROM (SELECT series_id, max(CASE WHEN i = n // 2 THEN ds END) AS view_start FROM (SELECT *, count(*) OVER (PARTITION BY series_id) AS n,
   row_number() OVER (PARTITION BY series_id ORDER BY ds) - 1 AS i FROM back) GROUP BY 1) b
 JOIN (SELECT series_id, count(*) FILTER (confidence = 'high') AS highs, count(*) FILTER (confidence = 'medium') AS mediums,
   max(ds) FILTER (confidence <> 'low') AS labelled, max(ds) FILTER (h = 14) AS quarter FROM labelled GROUP BY 1) f USING (series_id)""")
def _(spark, d):
    return evaluate.default_view_window(*_back_and_future(spark, d))


@query("model_store_load_or_fit", with_("supplier", AR_SQL) + """SELECT series_id, 'ar1' AS model, round(c, 6) AS const, round(phi, 6) AS phi,
round(sigma, 6) AS score, n FROM res""")
def _(spark, d):
    """A store of its own: half of the series are fitted, then all are asked for, of which the other half is new work."""
    arrays = materialize(train_arrays(prepared_panel(spark, d)), "arrays")
    path, family = scratch_path(spark, "param-store"), registry.FAMILIES["ar1"]
    for rows in (arrays.where(F.pmod(F.xxhash64("series_id"), F.lit(2)) == 0), arrays):
        found = param_store.load_or_fit(rows, "ar1", ("W-MON",), lambda todo: family.search(todo, "W-MON"), path)
    return found.select("series_id", "model", F.round(F.col("coef")[0], 6).alias("const"), F.round(F.col("coef")[2], 6).alias("phi"),
                        F.round("score", 6).alias("score"), "n")


RECENT_MEAN = """tails AS (SELECT series_id, w, avg(z) AS m FROM split, (VALUES (4), (12), (52)) v(w)
  WHERE split = 'train' AND t >= n - 52 - w GROUP BY 1, 2),
rated AS (SELECT c.series_id, c.w, c.m, sqrt(avg((x.z - c.m) * (x.z - c.m))) AS score FROM tails c
  JOIN split x ON x.series_id = c.series_id WHERE x.split = 'train' GROUP BY 1, 2, 3),
won AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY score, w) = 1),
preds AS (SELECT x.series_id, 'recent_mean' AS model, x.ds, CASE WHEN x.split = 'train' THEN 'fitted' ELSE 'forecast' END AS kind,
  w.m * x.scale + x.center AS yhat FROM split x JOIN won w ON w.series_id = x.series_id)"""


@query("run_search_log", with_("supplier", AR_SQL) + """SELECT series_id || '_ar1' AS dataset, 'ar1' AS model, '2024-05-06_07-08-09' AS date,
 round(sigma, 6) AS best_score, (SELECT count(*) FROM split s WHERE s.series_id = res.series_id AND s.split = 'train') AS n_samples FROM res""")
def _(spark, d):
    """What a run appends to the search log."""
    path = scratch_path(spark, "run-log")
    experiment.run_experiment(regular_panel(spark, d), ("ar1",), log=path, stamp=dt.datetime(2024, 5, 6, 7, 8, 9))
    return stores.read_search_log(spark, path).select(
        F.col("dataset_info.dataset_name_and_type").alias("dataset"), "model", "date", F.round("best_score", 6).alias("best_score"),
        F.col("dataset_info.n_samples").alias("n_samples"))


@query("register_forecaster", with_("priority", RECENT_MEAN, ALIGNED, SCORES) +
       "SELECT series_id, model, phase, mape, smape, cumulative_error_percentage, weighted_mape, round(error_std, 2) AS error_std FROM scores")
def _(spark, d):
    """A user's family: the mean of the last season, with its deviation as band."""
    import numpy as np

    def fit(values, params):
        tail = values[-int(params["window"]):]
        return np.array([tail.mean(), tail.std()]), float(np.sqrt(np.mean((values - tail.mean()) ** 2))), "ok"

    def apply(values, ds, params, coef, future):
        return np.full(len(values), coef[0]), np.full(len(future), coef[0]), np.full(len(future), coef[1])

    registry.register_simple_forecaster("recent_mean", fit, apply, {"window": ["4", "12", "52"]})
    run = experiment.run_experiment(regular_panel(spark, d, "priority"), ("recent_mean",))
    return rounded(run.scores, 2, "error_std")
