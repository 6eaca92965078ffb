"""Plans of the registered queries at the smallest scale: what is read and shuffled."""

import os
import re

import pytest

from panelcast.plans import all_queries

FOLDER = "/root/testdata/sf0.001"


def plan_of(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return all_queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
@pytest.mark.parametrize("name, exchanges", [
    ("evaluate_models", 3), ("best_model", 3), ("running_abs_pct_error", 3), ("training_mape", 3), ("hw_forecast", 2)])
def test_facts_are_read_once(spark, name, exchanges):
    plan = plan_of(spark, name)
    assert len(re.findall(r"FileScan parquet", plan)) == 1
    assert len(re.findall(r"\bExchange ", plan)) <= exchanges


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
@pytest.mark.parametrize("name", ["export_fits_wide", "export_metrics", "union_results",
                                  "ar_forecast", "ar_interval", "ar_fitted"])
def test_what_is_read_twice_is_written_first(spark, name):
    assert "lineitem.parquet" not in plan_of(spark, name)


def test_registered_tree_queries_search(monkeypatch):
    """Full draws of the tree families."""
    from panelcast.plans import experiment, model_queries

    class Reached(Exception):
        pass

    def reached(*args, **_):
        raise Reached(*args[1:])

    monkeypatch.setattr(model_queries.trees, "searched_trees", reached)
    monkeypatch.setattr(model_queries, "_tree_features", lambda *_: None)
    for family in experiment.TREE_FAMILIES:
        for kind in ("fit", "fitted", "forecast", "importance"):
            with pytest.raises(Reached) as asked:
                all_queries()[f"{family}_{kind}"](None, None)
            assert asked.value.args == (family, experiment.DEFAULT_DRAWS[family])


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
def test_sample_candidates_computes_its_panel_once(spark):
    assert "lineitem.parquet" not in plan_of(spark, "sample_candidates")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
def test_scores_are_computed_once_for_both_parts(spark, monkeypatch):
    from panelcast.plans import experiment, model_queries

    plans, run = [], model_queries._exact_run(spark, FOLDER)
    monkeypatch.setattr(model_queries, "_exact_run", lambda *_: run)
    monkeypatch.setattr(model_queries.experiment, "future_forecast_best", lambda given: plans.append(
        given.scores._jdf.queryExecution().executedPlan().toString()) or given.best)
    model_queries._back_and_future(spark, FOLDER)
    assert "Join" not in plans[0] and "Aggregate" not in plans[0]


def test_tree_forecast_derives_its_panel_once(spark, monkeypatch, tmp_path):
    from pyspark.sql import functions as F

    from panelcast.plans import model_queries, prepare

    folder, trees, derived, tables, panel = str(tmp_path), model_queries.trees, [], [], prepare.SOURCES["priority"]
    # Two orders a week and priority, one priority unknown.
    spark.range(2 * 3 * 220).select(
        F.element_at(F.array(F.lit("1-URGENT"), F.lit("5-LOW"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("o_orderpriority"),
        F.expr("timestamp_ntz'1995-01-02' + make_interval(0, 0, 0, cast(id div 6 as int) * 7)").alias("o_orderdate"),
        (100 + F.col("id") % 97 + F.rand(1)).alias("o_totalprice")).write.parquet(f"{folder}/orders.parquet")
    alone = trees.feature_table(model_queries._train(spark, folder, "priority"))
    model = trees.fit_trees(alone, "gb", {**trees.default_params("gb"), "n_estimators": "3", "max_depth": "3"})
    other = prepare.to_predictions(trees.trees_forecast(model_queries._arrays(spark, folder), model, "gb", model_queries.STEPS), fits=False)
    monkeypatch.setattr(trees, "searched_trees", lambda table, *_: tables.append(table) or (model, []))
    monkeypatch.setitem(prepare.SOURCES, "priority", lambda *a: derived.append(a) or panel(*a))
    made = all_queries()["gb_forecast"](spark, folder).collect()
    assert len(derived) == 1
    assert tables[0].coalesce(1).collect() == alone.coalesce(1).collect()  # draws go by the order of rows
    assert len(made) == 2 * model_queries.STEPS and sorted(made) == sorted(other.select(*made[0].asDict()).collect())
