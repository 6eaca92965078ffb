"""Stored fits: what is in the store is not fitted again, and what is not committed is not in the store."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import seasonal
from panelcast.models import registry, trees
from panelcast.plans import experiment
from panelcast.sources import param_store


@pytest.fixture
def store(tmp_path):
    return str(tmp_path / "store")


def fits(arrays, path, log, family="ar1"):
    def fit(todo):
        log.append(sorted(r[0] for r in todo.select("series_id").collect()))
        return registry.FAMILIES[family].search(todo, "W-MON")
    return param_store.load_or_fit(arrays, family, ("W-MON",), fit, path)


def test_only_what_is_missing_is_fitted(make_arrays, store):
    values = {name: seasonal(80, seed=i, noise=0.3) for i, name in enumerate("abc")}
    log = []
    first = fits(make_arrays({k: values[k] for k in "ab"}), store, log).collect()
    again = fits(make_arrays(values), store, log).collect()
    fits(make_arrays(values), store, log).collect()
    assert log == [["a", "b"], ["c"]]
    assert {r["series_id"]: r["score"] for r in first}.items() <= {r["series_id"]: r["score"] for r in again}.items()
    values["a"] = values["a"] + np.eye(1, 80, 5)[0]  # one changed value is new work, for that series alone
    fits(make_arrays(values), store, log).collect()
    assert log[2:] == [["a"]]


def test_failures_are_remembered(make_arrays, store):
    log = []
    arrays = make_arrays({"short": [1.0, 2.0], "long": seasonal(60)})
    for _ in range(2):
        assert [r["series_id"] for r in fits(arrays, store, log).collect()] == ["long"]
    assert log == [["long", "short"]]


def test_half_written_parts_are_not_seen(spark, make_arrays, store):
    log = []
    arrays = make_arrays({"a": seasonal(60)})
    fits(arrays, store, log).collect()
    part = param_store.committed_parts(spark, store)[0].removeprefix("file:")
    with open(f"{part}/_SUCCESS", "rb"):
        pass
    import os
    os.remove(f"{part}/_SUCCESS")
    assert param_store.read_params(spark, store).count() == 0
    fits(arrays, store, log).collect()
    assert log == [["a"], ["a"]]


def test_a_repeated_run_fits_nothing(make_panel, store, monkeypatch):
    panel = make_panel({name: 50 + seasonal(130, seed=i, noise=0.2) for i, name in enumerate("ab")})
    families = ("ar1", "hw_trend", "ets")
    first = experiment.run_experiment(panel, families, horizon=10, n_iter=3, store=store)
    scores = sorted(first.scores.collect())

    def fail(*_, **__):
        raise AssertionError("a stored family was searched")

    for name in families:
        old = registry.FAMILIES[name]
        monkeypatch.setitem(registry.FAMILIES, name, registry.Family(fail, old.predict, old.has_bands, old.version))
    second = experiment.run_experiment(panel, families, horizon=10, n_iter=3, store=store)
    assert sorted(second.scores.collect()) == scores
    ahead = experiment.future_forecast_best(second, 5)
    assert ahead.count() == 10 and ahead.where("confidence IS NULL").count() == 0


@pytest.mark.parametrize("family", ["gb", "rf"])
def test_staged_tree_search(make_panel, store, monkeypatch, family):
    """Scores are those of one training per setting and fold, and a second search reads the store."""
    few = {"n_estimators": ["2", "4"], "max_depth": ["2"]}
    grid = {k: few.get(k, v[:1]) for k, v in trees.GRIDS[family].items()}
    monkeypatch.setitem(trees.GRIDS, family, grid)
    prepared = experiment.prepare(make_panel({"a": seasonal(140, noise=0.2), "b": seasonal(140, seed=3, noise=0.2)}), 10)
    features = trees.feature_table(prepared.where("split = 'train'"))
    model, tried = trees.searched_trees(features, family, 2, folds=2, store=store)
    for params, score in tried:
        errors = []
        for fold in range(2):
            alone = trees.fit_trees(features.where(F.col("fold") != fold), family, params)
            held = alone.transform(features.where(F.col("fold") == fold))
            errors.append(held.agg(F.avg(F.pow(F.col("z") - F.col("prediction"), 2))).first()[0])
        assert score == pytest.approx(-np.mean(errors), rel=1e-9)
    assert model.getNumTrees == int(max(tried, key=lambda p: p[1])[0]["n_estimators"])
    monkeypatch.setattr(trees, "search_trees", None)
    loaded, again = trees.searched_trees(features, family, 2, folds=2, store=store)
    assert again == tried and loaded.toDebugString == model.toDebugString


def test_boosting_of_a_small_table_is_one_job_with_spark_ml_errors(make_panel, monkeypatch):
    """Only the winner is trained by Spark ML, a job per level of each tree; scores are those of its trainings."""
    few = {"n_estimators": ["3", "6"], "max_depth": ["2", "5"], "learning_rate": ["0.1"], "min_child_samples": ["1", "10"]}
    monkeypatch.setitem(trees.GRIDS, "gb", {k: few.get(k, v[:1]) for k, v in trees.GRIDS["gb"].items()})
    rounded = np.round(seasonal(150, seed=5, noise=0.3), 0)   # few values: equal gains
    prepared = experiment.prepare(make_panel({"a": seasonal(200, noise=0.2), "b": rounded, "c": np.full(120, 3.0)}), 10)
    features = trees.feature_table(prepared.where("split = 'train'"))
    trained, kept = [], trees._trained
    monkeypatch.setattr(trees, "_trained", lambda *a: trained.append(a) or kept(*a))
    best, together = trees.search_trees(features, "gb", 8, seed=3)
    assert len(trained) == 1
    monkeypatch.setattr(trees.boosting, "MOST_ROWS", 0)
    one_by_one, alone = trees.search_trees(features, "gb", 8, seed=3)
    assert len(trained) == 2 + 4 * 3 and best.toDebugString.split("\n", 1)[1] == one_by_one.toDebugString.split("\n", 1)[1]
    assert [p for p, _ in together] == [p for p, _ in alone]
    assert [s for _, s in together] == pytest.approx([s for _, s in alone], rel=1e-9)


def test_draws_are_those_of_spark(spark):
    """Draws of features agree with ``rand`` and with the JVM's generator, also for negative seeds."""
    seeds = trees.boosting._longs(np.array([7, -3], np.int64).view(np.uint64), 4)
    for seed, found in zip((7, -3), seeds):
        generator = spark._jvm.java.util.Random(seed)
        assert [generator.nextLong() for _ in range(4)] == found.tolist()
    flat = seeds.ravel()
    rows = spark.range(0, 3, 1, 1).select(*[F.rand(int(s)).alias(f"c{i}") for i, s in enumerate(flat)]).collect()
    assert trees.boosting._uniforms(flat, 3).T.tolist() == [list(r) for r in rows]


def test_runs_write_the_log_that_a_refit_reads(spark, make_panel, store, tmp_path):
    import datetime as dt

    from panelcast.sources import stores
    log, panel = str(tmp_path / "log"), make_panel({n: seasonal(90, seed=i, noise=0.3) for i, n in enumerate("ab")})
    for day in (1, 2):
        run = experiment.run_experiment(panel, ("ar1", "hw_simple"), horizon=12, store=store, log=log, stamp=dt.datetime(2024, 1, day))
    rows = stores.read_search_log(spark, log)
    assert rows.count() == 8 and {r.dataset_info.n_samples for r in rows.collect()} == {78}
    newest = stores.latest_best_params(rows).collect()
    assert {r.date for r in newest} == {"2024-01-02_00-00-00"} and len(newest) == 4
    own = experiment.future_forecast_best(run, 4).orderBy("series_id", "ds").collect()
    assert experiment.future_forecast_best(run, 4, log=log).orderBy("series_id", "ds").collect() == own
    winner = experiment.best_model(run.scores).where("series_id = 'a'").first().best_model
    changed = spark.createDataFrame([("a", {"k": "v"}, .5, 3)], "series_id string, params map<string,string>, score double, n_samples int")
    stores.append_search_log(stores.search_log_rows(changed, F.lit(dt.datetime(2024, 2, 1)), winner), log)
    winners = run.best.where(F.col("model") == winner)
    found = {r.series_id: r for r in experiment.with_logged_params(winners, log).collect()}
    assert (found["a"].params, found["a"].score) == ({"k": "v"}, .5) and found["b"].params != {"k": "v"}


def test_log_ties_and_half_written_parts(spark, tmp_path):
    from panelcast.schemas import SEARCH_LOG
    from panelcast.sources import stores
    path = str(tmp_path / "log")
    assert stores.read_search_log(spark, path).count() == 0
    rows = [("2024-01-01_00-00-00", "AR", {"p": p}, s, (5, "x_ar")) for p, s in (("1", 2.0), ("2", 1.0), ("3", 3.0))]
    stores.append_search_log(spark.createDataFrame(rows, SEARCH_LOG), path)
    (tmp_path / "log" / "part-unfinished").mkdir()
    (got,) = stores.latest_best_params(stores.read_search_log(spark, path)).collect()
    assert (got.best_params, got.best_score) == ({"p": "2"}, 1.0)


def test_keys_are_digested_once(make_arrays, tmp_path):
    """What is fitted comes from a written table of keys, not from another pass of digests."""
    seen = []

    def fit(todo):
        seen.append(todo._jdf.queryExecution().executedPlan().toString())
        return todo.select("series_id", F.lit(0).alias("candidate_id"), F.create_map(F.lit("a"), F.lit("b")).alias("params"),
                           F.array(F.lit(1.0)).alias("coef"), F.lit(9).cast("long").alias("n"), F.lit(0.5).alias("score"))

    found = param_store.load_or_fit(make_arrays({"a": [1.0, 2.0], "b": [3.0, 4.0]}), "m", ("s",), fit, str(tmp_path / "store"))
    assert {r.series_id for r in found.collect()} == {"a", "b"}
    assert "sha2(" not in seen[0] + found._jdf.queryExecution().executedPlan().toString()
