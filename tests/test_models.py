import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.functions.calendar import lags_of
from panelcast.models import arima, autoregression, bayes, learners, registry, smoothing, trees
from panelcast.operators import search
from panelcast.plans import experiment
from panelcast.plans.prepare import to_predictions
from conftest import seasonal


def ar1(n=500, phi=0.6, seed=0):
    rng, y = np.random.default_rng(seed), np.zeros(n)
    for t in range(1, n):
        y[t] = phi * y[t - 1] + rng.normal()
    return y


def test_ar_recovers_and_residuals_are_orthogonal(make_panel):
    y = ar1()
    train = make_panel({"a": y}).withColumn("z", F.col("y"))
    sums = autoregression.moments(train)
    best = autoregression.fit_ar(autoregression.with_fixed(sums, 2, "ct"))
    row = best.first()
    assert abs(row.coef[2] - 0.6) < 0.1
    fitted = np.array([r.zhat for r in autoregression.ar_fitted(train, best).orderBy("ds").collect()])
    e = y[2:] - fitted
    x = np.column_stack([np.ones(498), np.arange(3, 501), y[1:-1], y[:-2]])
    assert np.abs(x.T @ e).max() < 1e-5
    assert row.score == pytest.approx(np.sqrt(np.mean(e ** 2)))


def test_ar_candidates_equal_direct_least_squares(make_panel):
    """Every sub-model from the grouped sums equals its own regression."""
    y = seasonal(220, 52, noise=.3, seed=4)
    train = make_panel({"a": y}).withColumn("z", F.col("y"))
    fitted = autoregression.fit_ar(autoregression.with_candidates(autoregression.moments(train))).collect()
    assert len(fitted) == 40
    for row in fitted:
        p, trend = int(row.params["lags"]), row.params["trend"]
        t = np.arange(p, len(y))
        cols = [y[p - k:len(y) - k] for k in range(1, p + 1)]
        cols += ([np.ones(len(t))] if "c" in trend else []) + ([t + 1.0] if "t" in trend else [])
        if row.params["seasonal"] == "true":
            cols += [(t % 52 == s).astype(float) for s in range(1 if "c" in trend else 0, 52)]
        x = np.column_stack(cols)
        b = np.linalg.lstsq(x, y[p:], rcond=None)[0]
        assert row.score == pytest.approx(np.sqrt(np.mean((y[p:] - x @ b) ** 2)), rel=1e-4, abs=1e-5)


def test_ar_result_does_not_depend_on_partitions(make_panel):
    train = make_panel({str(i): ar1(150, seed=i) for i in range(6)}).withColumn("z", F.col("y"))
    fit = lambda df: {r.series_id: r.coef[2] for r in autoregression.fit_ar(
        autoregression.with_fixed(autoregression.moments(df))).collect()}
    assert fit(train.repartition(7)) == pytest.approx(fit(train.repartition(1)), abs=1e-9)


def smoothed(arrays, **kw):
    values = {"alpha": 0.5, "beta": 0.0, "gamma": 0.0, "phi": 1.0, "trend": "none"}
    season, kind = kw.pop("season", None), kw.pop("seasonal", "none")
    values.update(kw)
    rows = smoothing.start_values(arrays.withColumn("trend", F.lit(values.pop("trend"))), season, kind)
    return smoothing.smooth(rows.withColumns({k: F.lit(float(v)) for k, v in values.items()}))


def test_full_smoothing_is_the_naive_forecast(make_arrays):
    y = ar1(60)
    row = smoothed(make_arrays({"a": y}), alpha=1.0).withColumn("ahead", smoothing.forecast_array(4)).first()
    assert row.fitted == pytest.approx([y[0], *y[:-1]])
    assert row.ahead == pytest.approx([y[-1]] * 4)


@pytest.mark.parametrize("trend,kind", [("none", "none"), ("add", "none"), ("add", "add"), ("mul", "add"), ("add", "mul"), ("mul", "mul")])
def test_jvm_recursion_equals_numpy(make_arrays, trend, kind):
    y = seasonal(80, 12, noise=.1) + 5
    row = smoothed(make_arrays({"a": y}), alpha=.3, beta=.05, gamma=.2, phi=.95, trend=trend, season=12, seasonal=kind).first()
    start = smoothing._legacy_start(y, 12, trend, kind)[:, None]
    weights = [np.array([v]) for v in (.3, .05, .2, .95)]
    want = smoothing._one_step(y, weights, start, 12 if kind != "none" else 1, trend, kind)[:, 0]
    assert row.fitted == pytest.approx(want)


def test_noise_free_trend_and_season_are_reproduced(make_arrays):
    y = seasonal(120, 12)
    params = {"error": "add", "trend": "add", "seasonal": "add", "seasonal_periods": "12", "damped_trend": "false"}
    coef, score, status = smoothing.fit_smoothing(y[:96], params)
    assert status == "ok" and score < 1e-3
    best = search.explode_grid(make_arrays({"a": y[:96]}).select("series_id"), "ets", {k: [v] for k, v in params.items()})
    best = best.withColumn("coef", F.array(*[F.lit(float(c)) for c in coef]))
    made = smoothing.predict(best.select("series_id", "model", "params", "coef"), make_arrays({"a": y[:96]}), 24).first()
    assert made.ahead == pytest.approx(y[96:], abs=1e-2)
    assert all(l <= f <= u for l, f, u in zip(made.lower, made.ahead, made.upper))


def test_candidates_that_cannot_apply_keep_a_reason(make_arrays):
    arrays = make_arrays({"neg": ar1(60), "pos": seasonal(60, 4) + 5})
    scored = smoothing.search(arrays, "hw", smoothing.hw_grid("W-MON"), 8).collect()
    assert {r.status.split(":")[0] for r in scored} == {"ok", "failed"}
    for r in scored:
        if r.series_id == "neg" and "mul" in (r.params["trend"], r.params["seasonal"]):
            assert r.status.startswith("failed")
    # 24 draws: enough valid ones for the positive series, perhaps not for the other.
    valid = {s: sum(r.status == "ok" for r in scored if r.series_id == s) for s in ("neg", "pos")}
    assert valid["pos"] == 8 and 1 <= valid["neg"] <= 8


def test_multiplicative_bands_contain_the_point(make_arrays):
    arrays = make_arrays({"a": seasonal(60, 4, noise=.1) + 5})
    params = {"error": "mul", "trend": "add", "seasonal": "mul", "seasonal_periods": "4", "damped_trend": "true"}
    rows = search.explode_grid(arrays.select("series_id", "z"), "ets", {k: [v] for k, v in params.items()})
    best = search.pick_best_candidate(search.fit_candidates(rows, smoothing.fit_smoothing))
    made = smoothing.predict(best.select("series_id", "model", "params", "coef"), arrays, 12).first()
    assert all(l < f < u for l, f, u in zip(made.lower, made.ahead, made.upper))
    assert np.all(np.diff(np.array(made.upper) - np.array(made.lower))[[0, 4]] > 0)


def test_arima_on_known_processes():
    y = ar1(400)
    coef, score, status = arima.fit_arima(y, {"p": "1", "d": "0", "q": "0", "trend": "n"})
    assert status == "ok" and abs(coef[0] - .6) < .1 and abs(score - 1) < .1
    ds = np.datetime64("2020-01-06") + 7 * np.arange(400)
    _, ahead, se = arima.apply_arima(y, ds, {"p": "1", "trend": "n"}, coef, ds[:5])
    assert ahead == pytest.approx(y[-1] * coef[0] ** np.arange(1, 6))
    assert se == pytest.approx(np.sqrt(np.mean((y[1:] - coef[0] * y[:-1]) ** 2) * np.cumsum(coef[0] ** (2 * np.arange(5)))), rel=1e-2)
    line = 3 + 2.0 * np.arange(100)
    flat, _, _ = arima.fit_arima(line, {"d": "2", "trend": "n"})
    _, ahead, _ = arima.apply_arima(line, ds[:100], {"d": "2", "trend": "n"}, flat, ds[:4])
    assert ahead == pytest.approx(3 + 2.0 * np.arange(100, 104))
    season = np.tile(np.arange(12.0), 10)
    none, _, _ = arima.fit_arima(season, {"D": "1", "s": "12", "trend": "n"})
    fits, ahead, _ = arima.apply_arima(season, ds[:120], {"D": "1", "s": "12", "trend": "n"}, none, ds[:12])
    assert ahead == pytest.approx(np.arange(12.0)) and len(fits) == 108


def test_arima_moving_average_residuals_match_a_plain_loop():
    rng = np.random.default_rng(5)
    w, theta = rng.normal(size=60), np.array([.4, -.3, .2])
    e = arima._residuals(w, [theta], (1, 0, 1, 0, 0, 1, 4), "n", 1)[:, 0]
    plain = np.zeros(60)
    for t in range(1, 60):
        lag = lambda x, k: x[t - k] if t >= k else 0.0
        plain[t] = w[t] - .4 * lag(w, 1) - (-.3 * lag(plain, 1) + .2 * lag(plain, 4) - .06 * lag(plain, 5))
    assert e[1:] == pytest.approx(plain[1:]) and e[0] == w[0]


def test_bayes_posterior_matches_a_dense_solve(make_panel):
    y = seasonal(200, 52, slope=.01, noise=.2)
    train = make_panel({"a": y}).withColumn("z", F.col("y"))
    row = bayes.bayes_fit(train, learn_scales=False, rounds=40).first()
    n, c = len(y), np.median(y)
    x = np.zeros((n, 54))
    x[:, 0], x[:, 1] = 1, np.arange(n)
    x[np.arange(n), 2 + np.arange(n) % 52] = 1
    prior = np.diag(1 / np.r_[4.0, 1.0, np.full(52, 4.0)])
    mean = np.linalg.solve(x.T @ x / row.sigma2 + prior, x.T @ (y - c) / row.sigma2)
    shift = mean[2:].mean()
    assert row.coef == pytest.approx(np.r_[mean[0] + c + shift, mean[1], mean[2:] - shift], abs=1e-6)
    assert abs(sum(row.coef[2:])) < 1e-9


def test_svr_solution_satisfies_its_conditions():
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(120, 4)), rng.normal(size=120)
    params = {"kernel": "rbf", "C": "1", "epsilon": "0.1"}
    beta = learners.fit_svr(x, y, params)
    assert np.abs(beta).max() <= 1 + 1e-12
    e = y - learners._kernel(x, x, params) @ beta
    free = (np.abs(beta) > 1e-6) & (np.abs(beta) < 1 - 1e-6)
    assert np.abs(np.abs(e[free]) - .1).max() < 1e-2
    assert np.abs(e[np.abs(beta) < 1e-9]).max() < .1 + 1e-2


def test_mlp_beats_the_mean_and_repeats():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(200, 5))
    y = x[:, 0] - .5 * x[:, 1] + .1 * rng.normal(size=200)
    params = {"hidden_layer_sizes": "10,5", "activation": "relu", "alpha": "0.01"}
    coef = learners._fit("mlp", x, y, params)
    assert np.array_equal(coef, learners._fit("mlp", x, y, params))
    fit = learners._predictor("mlp", params, coef, x)(x)
    assert np.mean((y - fit) ** 2) < .3 * np.var(y)


def test_worker_features_equal_column_features(make_panel):
    from panelcast.operators.features import feature_names, lag_features
    y = ar1(70)
    panel = make_panel({"a": y}, freq="D").withColumn("z", F.col("y"))
    lags = [1, 3, 7]
    rows = lag_features(panel, lags=lags).orderBy("ds").collect()
    ds = np.array([np.datetime64("2020-01-06") + i for i in range(70)])
    x, target = learners.feature_matrix(y, ds, lags)
    assert np.allclose(x, [[r[n] for n in feature_names(lags)] for r in rows])
    assert np.allclose(target, [r.z for r in rows])


def test_tree_forecast_feeds_predictions_back(spark, make_panel):
    from pyspark.ml.linalg import Vectors
    series = {str(i): seasonal(150, 52, noise=.2, seed=i) for i in range(3)}
    train = make_panel(series).withColumns({"z": F.col("y"), "center": F.lit(0.0), "scale": F.lit(1.0)})
    table = trees.feature_table(train)
    for family in ("gb", "rf"):
        params = {**trees.default_params(family), "n_estimators": "4", "max_depth": "3"}
        model = trees.fit_trees(table, family, params)
        total = trees.importance(table, model, family).agg(F.sum("importance")).first()[0]
        assert total == pytest.approx(1.0)
    arrays = train.groupBy("series_id", "center", "scale").agg(F.sort_array(F.collect_list(F.struct("ds", "z"))).alias("p")).select(
        "series_id", "center", "scale", F.col("p.ds").alias("ds"), F.col("p.z").alias("z"))
    ahead = {r.series_id: r.ahead for r in trees.trees_forecast(arrays, model, "rf", 10).collect()}
    dates = np.array([np.datetime64("2020-01-06") + 7 * i for i in range(160)])
    for name, values in series.items():
        known = list(values)
        for h in range(10):
            x, _ = learners.feature_matrix(np.array([*known, 0.0]), dates[:len(known) + 1], lags_of("W-MON"))
            known.append(model.predict(Vectors.dense(x[-1])))
        assert ahead[name] == pytest.approx(known[-10:])
    best, tried = trees.search_trees(table.limit(200), "rf", 1)
    assert len(tried) == 1 and tried[0][1] < 0 and set(tried[0][0]) == set(trees.RF_GRID)


def test_failed_fits_do_not_stop_the_job(spark, make_arrays):
    """One series with an infinite value: its candidates fail, the others are fitted."""
    arrays = make_arrays({"a": seasonal(190, 52, noise=.2), "b": np.r_[seasonal(189, 52, noise=.2), np.inf]})
    best = {r.series_id for r in registry.FAMILIES["svr"].search(arrays, "W-MON", 2, 0).collect()}
    assert best == {"a"}


def test_odd_steps_stop_the_run(spark, make_panel):
    panel = make_panel({"x": seasonal(60, 12)}).where("weekofyear(ds) % 2 = 0")
    config = spark.createDataFrame([], "series_id string, freq string")
    with pytest.raises(ValueError, match="1 series"):
        experiment.run_by_frequency(panel, config, families=("ar",))


@pytest.mark.parametrize("name", ["ets", "hw", "arima", "prophet", "svr", "mlp", "ssm", "ar", "bayes"])
def test_family_contract(make_panel, name):
    """Every family: exact steps, dates of the future calendar, fits in order."""
    panel = make_panel({str(i): seasonal(190, 52, noise=.2, seed=i) + 5 for i in range(2)})
    # One in six smoothing candidates applies to scaled values, so these families draw more.
    run = experiment.run_experiment(panel, (name,), n_iter=25 if name in ("ets", "hw") else 3, horizon=20)
    rows = run.predictions.collect()
    for series in ("0", "1"):
        ahead = sorted(r.ds for r in rows if r.series_id == series and r.kind == "forecast")
        assert ahead == [dt.date(2020, 1, 6) + dt.timedelta(weeks=170 + i) for i in range(20)]
        fits = [r for r in rows if r.series_id == series and r.kind == "fitted"]
        assert 60 <= len(fits) <= 170 and len({r.ds for r in fits}) == len(fits)
    assert all(r.lower <= r.yhat <= r.upper for r in rows if r.lower is not None)
    testing = [r for r in run.scores.collect() if r.phase == "testing"]
    assert len(testing) == 2 and all(r.weighted_mape < .5 for r in testing)
    future = experiment.future_forecast_best(run, periods=7).collect()
    assert len(future) == 14 and min(r.ds for r in future) == dt.date(2020, 1, 6) + dt.timedelta(weeks=190)
    assert all((r.confidence is not None) == registry.FAMILIES[name].has_bands for r in future)


def test_registered_forecaster(make_panel):
    def fit(values, params):
        return np.array([values.mean()]), 1.0, "ok"

    def apply(values, ds, params, coef, future):
        return np.full(len(values), coef[0]), np.full(len(future), coef[0]), np.ones(len(future))

    registry.register_simple_forecaster("mean", fit, apply, {"x": ["1"]})
    run = experiment.run_experiment(make_panel({"a": seasonal(100, 12)}), ("mean",), horizon=10)
    assert run.predictions.where("kind = 'forecast'").count() == 10


def test_predictions_of_arrays_start_at_their_offset(make_arrays):
    rows = make_arrays({"a": range(10)}).withColumns({
        "model": F.lit("m"), "fitted": F.array(F.lit(1.0), F.lit(2.0)), "ahead": F.array(F.lit(3.0)), "offset": F.lit(8)})
    got = to_predictions(rows).orderBy("ds").collect()
    assert [(str(r.ds), r.yhat) for r in got] == [("2020-03-02", 1.0), ("2020-03-09", 2.0), ("2020-03-16", 3.0)]


def test_mixed_frequencies(make_panel, spark):
    weekly = make_panel({"w": seasonal(120, 12) + 5}, start="2020-01-05", freq="W-SUN")
    daily = make_panel({"d": seasonal(90, 7) + 5}, freq="D")
    config = spark.createDataFrame([("d", "D")], "series_id string, freq string")
    runs = experiment.run_by_frequency(weekly.unionByName(daily), config, families=("ar",), horizon=10)
    assert set(runs) == {"W-SUN", "D"}
    for freq, step in (("W-SUN", 7), ("D", 1)):
        dates = sorted(r.ds for r in runs[freq].predictions.where("kind = 'forecast'").collect())
        assert len(dates) == 10 and {(b - a).days for a, b in zip(dates, dates[1:])} == {step}


def test_very_short_series_do_not_stop_a_job(make_arrays):
    """Rows too short for a model give nulls or a failure status, never an error."""
    arrays = make_arrays({"one": [1.0], "three": [1.0, 2.0, 4.0], "long": ar1(120)})
    row = {r.series_id: r for r in smoothed(arrays, trend="add").withColumn("ahead", smoothing.forecast_array(2)).collect()}
    assert row["one"].ahead == [None, None] and None not in row["long"].ahead
    for name in ("ets", "arima", "ssm", "ar", "svr", "prophet"):
        best = registry.FAMILIES[name].search(arrays, "W-MON", 20, 0)
        assert "long" in {r.series_id for r in best.collect()}, name
    best = registry.FAMILIES["ar"].search(arrays, "W-MON", 40, 0)
    assert registry.FAMILIES["ar"].predict(best, arrays, 3, "W-MON").count() >= 1


def test_fit_ar_works_through_a_batch_in_small_pieces(make_panel, monkeypatch):
    """What a task returns at once is bounded, however many series Spark puts in a batch."""
    panel = make_panel({str(k): seasonal(80, 12) + k for k in range(7)}).withColumn("z", F.col("y"))
    sums = autoregression.with_candidates(autoregression.moments(panel)).coalesce(1)
    whole = {(r.series_id, r.candidate_id): r.score for r in autoregression.fit_ar(sums).collect()}
    (batch,), sizes = sums.toArrow().combine_chunks().to_batches(), []
    monkeypatch.setattr(autoregression, "SERIES_AT_ONCE", 2)

    class Rows:
        def mapInArrow(self, run, schema):
            return list(run(iter([batch])))

    parts = autoregression.fit_ar(Rows())
    assert [p.num_rows for p in parts] == [80, 80, 80, 40]
    assert {(r["series_id"], r["candidate_id"]): r["score"] for p in parts for r in p.to_pylist()} == pytest.approx(whole, nan_ok=True)


def test_bands_evaluate_the_variance_once_a_row(spark):
    """One variance for all steps; inside the lambda it was evaluated for every step."""
    zeros, ones = (F.array(*[F.lit(v)] * 20) for v in (0.0, 1.0))
    lower, _ = smoothing.bands(zeros, F.rand(1), ones)
    assert len(set(spark.range(1).select(lower.alias("lower")).first().lower)) == 1


def test_sums_without_season_have_a_part_per_head_position(make_panel):
    train = make_panel({"a": seasonal(220, 52, noise=.3, seed=4)}).withColumn("z", F.col("y"))
    plain, seasons = autoregression.moments(train, seasonal=False), autoregression.moments(train)
    assert len(plain.first().head) == 6 < len(seasons.first().head)
    a, b = (autoregression.fit_ar(autoregression.with_fixed(s)).first() for s in (plain, seasons))
    assert a.coef == pytest.approx(b.coef) and a.score == pytest.approx(b.score) and a.n == b.n
