import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.functions import metrics
from panelcast.operators import evaluate, features, grid, search


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    y, yhat = rng.normal(5, 3, 200), rng.normal(5, 3, 200)
    rows = [("a", "m", "testing", float(a), float(b)) for a, b in zip(y, yhat)]
    rows += [("zeros", "m", "testing", 0.0, 1.0), ("zeros", "m", "testing", 2.0, 1.0), ("zeros", "m", "testing", 0.0, 0.0)]
    df = spark.createDataFrame(rows, "series_id string, model string, phase string, y double, yhat double")
    out = evaluate.score(df, list(metrics.METRICS) + ["value_weighted_error", "rmse"])
    return y, yhat, {r.series_id: r for r in out.collect()}


def test_metrics_match_numpy(scored):
    y, yhat, rows = scored
    e = np.abs(y - yhat)
    got = rows["a"]
    assert got.mape == round(np.mean(e / y), 2)
    assert got.smape == round(np.mean(e / ((np.abs(y) + np.abs(yhat)) / 2)), 2)
    assert got.cumulative_error_percentage == round(abs(y.sum() - yhat.sum()) / abs(y.sum()), 2)
    assert got.weighted_mape == round(e.sum() / np.abs(y).sum(), 2)
    assert got.error_std == pytest.approx(np.std(y - yhat))
    assert got.value_weighted_error == pytest.approx((e * np.abs(y)).sum() / (y ** 2).sum())
    assert got.rmse == pytest.approx(np.sqrt((e ** 2).mean()))


def test_zero_actuals(scored):
    got = scored[2]["zeros"]
    assert got.mape is None and got.weighted_mape is None
    assert got.smape == round((2 + 1 / 1.5 + 0) / 3, 2)


def test_ties_rank_by_name_and_confidence(spark):
    rows = [("s", "b", "testing", 0.1), ("s", "a", "testing", 0.1), ("s", "c", "testing", None), ("s", "z", "training", 0.0)]
    df = spark.createDataFrame(rows, "series_id string, model string, phase string, weighted_mape double")
    assert evaluate.best_model(df).first().best_model == "a"
    ranks = {r.model: r["rank"] for r in evaluate.rank_models(df).where("phase = 'testing'").collect()}
    assert ranks == {"a": 1, "b": 2, "c": 3}
    bands = spark.createDataFrame([(10.0, 9.5, 10.5), (-10.0, -11.5, -8.5), (10.0, 5.0, 15.0), (0.0, -1.0, 1.0)], "f double, l double, u double")
    labels = [r[0] for r in bands.select(evaluate.confidence_label(F.col("f"), F.col("l"), F.col("u"))).collect()]
    assert labels == ["high", "medium", "low", "low"]


def test_default_view_without_levels(make_panel, spark):
    back = make_panel({"s": range(52)}).withColumn("yhat", F.col("y"))
    future = grid.future_calendar(back, 40).withColumn("confidence", F.lit("high"))
    row = evaluate.default_view_window(back, future).first()
    dates = sorted(r.ds for r in future.collect())
    assert row.limited_confidence and row.view_end == dates[10]


def test_running_error_is_capped(make_panel):
    df = make_panel({"s": [1.0, 0.0, 2.0, 4.0]}).withColumns({"model": F.lit("m"), "yhat": F.lit(3.0)})
    got = [r.running_error for r in evaluate.running_abs_pct_error(df).orderBy("ds").collect()]
    assert got == pytest.approx([100, 100, (100 + 100 + 50) / 3, (100 + 100 + 50 + 25) / 4])


def test_folds_match_contiguous_split(make_panel):
    panel = make_panel({"a": range(10), "b": range(11), "c": range(12)})
    for name, n in (("a", 10), ("b", 11), ("c", 12)):
        got = [r.fold for r in search.kfold(panel.where(F.col("series_id") == name)).orderBy("ds").collect()]
        wanted = np.concatenate([[i] * len(p) for i, p in enumerate(np.array_split(np.arange(n), 3))])
        assert got == list(wanted)


def test_sampling_is_reproducible_and_partition_free(spark):
    grid_ = {"p": ["1", "2", "3"], "q": ["a", "b"], "r": ["x", "y", "z"]}
    series = spark.createDataFrame([(f"s{i}",) for i in range(20)], "series_id string")
    keys = lambda df: sorted((r.series_id, r.candidate_id, tuple(sorted(r.params.items()))) for r in df.collect())
    once = search.sample_candidates(series, "m", grid_, 5, seed=1)
    assert keys(once) == keys(search.sample_candidates(series.repartition(7), "m", grid_, 5, seed=1))
    assert keys(once) != keys(search.sample_candidates(series, "m", grid_, 5, seed=2))
    assert once.groupBy("series_id").count().where("count <> 5").count() == 0
    every = search.sample_candidates(series, "m", grid_, 99)
    assert every.groupBy("series_id").agg(F.count_distinct("candidate_id").alias("n")).where("n <> 18").count() == 0
    full = search.explode_grid(series.limit(1), "m", grid_).collect()
    assert len({tuple(sorted(r.params.items())) for r in full}) == 18


def test_first_candidate_wins_ties_and_failures_are_skipped(spark):
    rows = [("s", "m", 2, 0.5, "ok"), ("s", "m", 1, 0.5, "ok"), ("s", "m", 0, 0.1, "failed: x"), ("s", "m", 3, None, "ok")]
    df = spark.createDataFrame(rows, "series_id string, model string, candidate_id int, score double, status string")
    assert search.pick_best_candidate(df).first().candidate_id == 1


def test_recursive_forecast_uses_zero_for_short_history(make_arrays):
    arrays = make_arrays({"s": [1.0, 2.0, 3.0]})
    ahead = features.recursive_forecast(F.array(F.lit(0.5), F.lit(0.25)), F.lit(1.0), [1, 5], 3)
    got = arrays.select(ahead.alias("a")).first().a
    history = [1.0, 2.0, 3.0]
    for _ in range(3):
        fifth = history[-5] if len(history) >= 5 else 0.0
        history.append(1 + .5 * history[-1] + .25 * fifth)
    assert got == pytest.approx(history[3:])


def test_a_zero_actual_leaves_a_winner(spark):
    scores = spark.createDataFrame([("s", "a", "testing", None, 3.0, 1.0), ("s", "b", "testing", None, 2.0, 4.0), ("t", "a", "testing", .1, 1.0, 1.0)],
                                   "series_id string, model string, phase string, weighted_mape double, smape double, error_std double")
    got = {r.series_id: (r.best_model, r.weighted_mape) for r in evaluate.best_model(scores).collect()}
    assert got == {"s": ("b", None), "t": ("a", .1)}
