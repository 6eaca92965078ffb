"""Gradient-boosted trees and random forests on lag and calendar features.

One model is trained over the whole scaled panel (per frequency), by Spark ML,
and applied to all series at once, also for the step-by-step forecast.
"""

from __future__ import annotations

import hashlib
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from panelcast.functions.calendar import future_array, lags_of
from panelcast.models import boosting
from panelcast.operators.features import calendar_features, feature_names, lag_features, lag_from_end
from panelcast.operators.search import grid_size, kfold
from panelcast.session import materialize
from panelcast.sources.param_store import committed, default_store

# Search grids.  num_leaves, reg_alpha and reg_lambda have no
# counterpart in Spark ML and stay in the candidate table without effect.
GB_GRID = {
    "num_leaves": ["15", "31"], "max_depth": ["5", "8"], "learning_rate": ["0.05", "0.1"],
    "n_estimators": ["50", "100"], "min_child_samples": ["10", "20"], "subsample": ["0.8"],
    "colsample_bytree": ["0.8"], "reg_alpha": ["0.1"], "reg_lambda": ["0.1"]}
RF_GRID = {
    "n_estimators": ["50", "100"], "max_depth": ["5", "10"], "min_samples_split": ["5", "10"],
    "min_samples_leaf": ["4", "8"], "max_features": ["sqrt"], "bootstrap": ["true"], "max_samples": ["0.8"]}
STEPS_PER_PLAN = 8
ROWS_PER_TASK = 20_000
GRIDS = {"gb": GB_GRID, "rf": RF_GRID}
TREES = {"gb": "maxIter", "rf": "numTrees"}


def default_params(family: str) -> dict[str, str]:
    return {name: values[0] for name, values in GRIDS[family].items()}


def sampled_params(family: str, n_iter: int, seed: int = 0) -> list[dict[str, str]]:
    """``n_iter`` different combinations in a seeded order."""
    grid = GRIDS[family]
    chosen = np.random.default_rng(seed).permutation(grid_size(grid))[:n_iter]
    out = []
    for number in chosen:
        params, stride = {}, grid_size(grid)
        for name, values in grid.items():
            stride //= len(values)
            params[name] = values[(number // stride) % len(values)]
        out.append(params)
    return out


def _settings(family: str, params: dict[str, str]) -> dict:
    if family == "gb":
        return {"maxIter": int(params["n_estimators"]), "maxDepth": int(params["max_depth"]),
                "stepSize": float(params["learning_rate"]), "minInstancesPerNode": int(params["min_child_samples"]),
                "subsamplingRate": float(params["subsample"]), "featureSubsetStrategy": params["colsample_bytree"]}
    # A node is split only if it holds min_samples_split rows, hence half of
    # that is the least a child can be asked for.
    leaf = max(int(params["min_samples_leaf"]), int(params["min_samples_split"]) // 2)
    return {"numTrees": int(params["n_estimators"]), "maxDepth": int(params["max_depth"]),
            "minInstancesPerNode": leaf, "featureSubsetStrategy": params["max_features"],
            "subsamplingRate": float(params["max_samples"]), "bootstrap": params["bootstrap"] == "true"}


def _estimator(family: str, params: dict[str, str] | None = None, seed: int = 0):
    kind = GBTRegressor if family == "gb" else RandomForestRegressor
    # 64 bins describe lag values well at any row count.
    estimator = kind(featuresCol="features", labelCol="z", seed=seed, maxBins=64, maxMemoryInMB=1024)
    return estimator.setParams(**_settings(family, params or default_params(family)))


def feature_table(prepared_train: DataFrame, freq: str = "W-MON") -> DataFrame:
    """Feature vectors of all series, written once because training reads them
    for every level of every tree."""
    lags = lags_of(freq)
    rows = kfold(lag_features(prepared_train, freq))
    vectors = VectorAssembler(inputCols=feature_names(lags), outputCol="features").transform(rows)
    return materialize(vectors.select("series_id", "ds", "center", "scale", "z", "features", "fold"), "features")


def fit_trees(features: DataFrame, family: str, params: dict[str, str] | None = None, seed: int = 0):
    return _estimator(family, params, seed).fit(features)


def search_trees(features: DataFrame, family: str, n_iter: int, folds: int = 3, seed: int = 0,
                 parallelism: int = 8):
    """Best model and ``(params, score)`` pairs by contiguous folds.

    The fold of a row is its block of time within its series.  Scores are
    negative mean squared errors.  Combinations that differ only in what Spark ML
    does not know are trained once.  Boosting is searched in stages: fewer trees
    are the first of more, so combinations that differ in the number of trees
    share one training per fold, which is scored after each tree.  On tables of
    few rows all these trainings are one job (``boosting``), with the same errors.
    """
    tried = sampled_params(family, n_iter, seed)
    settings = [tuple(sorted(_settings(family, params).items())) for params in tried]
    # A task per core and enough rows to be worth it: small tables train in few tasks.
    spark = features.sparkSession
    held, rows, blocks = features.select("fold", F.spark_partition_id().alias("part")).agg(
        F.countDistinct("part"), F.count("*"), F.collect_set("fold")).first()
    tasks = max(1, min(held, rows // ROWS_PER_TASK))
    features = features.coalesce(tasks).persist()
    stages = _stages(family, settings)
    work = [(shared, fold) for shared in stages for fold in range(folds)]
    small = family == "gb" and tasks == 1 and rows <= boosting.MOST_ROWS and len(blocks) > 1 and {*range(folds)} <= {*blocks}

    def errors(job) -> dict[int, float]:
        shared, fold = job
        model = _trained(features.where(F.col("fold") != fold), family, {**dict(shared), TREES[family]: max(stages[shared])}, seed)
        held_out = features.where(F.col("fold") == fold)
        if family == "gb":
            after = model.evaluateEachIteration(held_out, "squared")
            return {n: after[n - 1] for n in stages[shared]}
        mse = RegressionEvaluator(labelCol="z", metricName="mse").evaluate(model.transform(held_out))
        return {n: mse for n in stages[shared]}

    if small:
        found = _all_at_once(features, stages, work, folds, seed, rows)
    else:
        with ThreadPool(min(parallelism, len(work))) as pool:
            found = pool.map(inheritable_thread_target(spark)(errors), work)
    sums: dict[tuple, float] = {}
    for (shared, _), after in zip(work, found):
        for n, error in after.items():
            sums[shared, n] = sums.get((shared, n), 0.0) + error / folds
    scores = {s: sums[_shared(family, s), dict(s)[TREES[family]]] for s in settings}
    best = _trained(features, family, dict(min(settings, key=scores.__getitem__)), seed)
    features.unpersist()
    return best, [(p, -scores[s]) for p, s in zip(tried, settings)]


def _all_at_once(features: DataFrame, stages: dict[tuple, list[int]], work: list[tuple], folds: int, seed: int,
                 rows: int) -> list[dict[int, float]]:
    """Errors of boosting by number of trees for each training of ``work``, all in one job."""
    settings = [(dict(shared), max(asked)) for shared, asked in stages.items()]
    after = boosting.boosting_errors(features, settings, folds, seed, rows, _estimator("gb").getMaxBins())
    number = {shared: i for i, shared in enumerate(stages)}
    return [{n: after[number[shared], fold][n - 1] for n in stages[shared]} for shared, fold in work]


def _shared(family: str, setting: tuple) -> tuple:
    """What trainings have in common; a forest is trained once per number of trees."""
    return tuple(x for x in setting if x[0] != TREES[family]) if family == "gb" else setting


def _stages(family: str, settings: list[tuple]) -> dict[tuple, list[int]]:
    """Numbers of trees asked for, by what trainings have in common."""
    out: dict[tuple, list[int]] = {}
    for setting in dict.fromkeys(settings):
        out.setdefault(_shared(family, setting), []).append(dict(setting)[TREES[family]])
    return out


def _trained(features: DataFrame, family: str, setting: dict, seed: int):
    estimator = _estimator(family, seed=seed)
    return estimator.fit(features, {estimator.getParam(k): v for k, v in setting.items()})


def searched_trees(features: DataFrame, family: str, n_iter: int, folds: int = 3, seed: int = 0, store: str | None = None):
    """As ``search_trees``, kept in the store under a digest of the rows and the search.

    The digest does not depend on the order of rows.  The model is written
    first, the scores last; an entry without scores is no entry.
    """
    spark = features.sparkSession
    rows = features.agg(F.count("*"), F.sum(F.xxhash64("series_id", "ds", "z", "fold").cast("decimal(38,0)"))).first()
    key = hashlib.sha256(repr((tuple(rows), family, GRIDS[family], n_iter, folds, seed)).encode()).hexdigest()
    path = f"{store or default_store(spark)}-trees/{key}"
    kind = GBTRegressionModel if family == "gb" else RandomForestRegressionModel
    if not committed(spark, f"{path}/scores"):
        model, tried = search_trees(features, family, n_iter, folds, seed)
        model.write().overwrite().save(f"{path}/model")
        spark.createDataFrame([(i, p, s) for i, (p, s) in enumerate(tried)], "i int, params map<string,string>, score double") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/scores")
    tried = spark.read.parquet(f"{path}/scores").orderBy("i").collect()  # one row per draw
    return kind.load(f"{path}/model"), [(dict(r["params"]), r["score"]) for r in tried]


def trees_forecast(arrays: DataFrame, model, family: str, steps: int, freq: str = "W-MON") -> DataFrame:
    """Recursive forecasts ``ahead``: predict a step, append it, repeat.

    A row carries its own recent history, so a step is a projection and
    ``model.transform``, without join or exchange.  Rows are written every
    ``STEPS_PER_PLAN`` steps to keep plans short.
    """
    lags = lags_of(freq)
    longest = max(lags)
    assemble = VectorAssembler(inputCols=feature_names(lags), outputCol="features")
    tail = F.slice("z", F.greatest(F.size("z") - longest + 1, F.lit(1)), longest)
    rows = arrays.select("series_id", F.element_at("ds", -1).alias("last"), tail.alias("history"))
    for step in range(steps):
        following = F.element_at(future_array(F.col("last"), 1, freq), 1)
        asked = rows.select("series_id", "history", following.alias("ds"),
                            *[lag_from_end(F.col("history"), k).alias(f"lag_{k}") for k in lags])
        made = model.transform(assemble.transform(calendar_features(asked)))
        rows = made.select("series_id", F.col("ds").alias("last"),
                           F.concat("history", F.array("prediction")).alias("history"))
        if (step + 1) % STEPS_PER_PLAN == 0 and step + 1 < steps:
            rows = materialize(rows, "tree-steps")
    ahead = F.slice("history", F.size("history") - steps + 1, steps).alias("ahead")
    return (arrays.select("series_id", F.lit(family).alias("model"), "center", "scale", "ds")
            .join(rows.select("series_id", ahead), "series_id"))


def trees_fitted(features: DataFrame, model, family: str) -> DataFrame:
    """In-sample predictions ``zhat`` of rows that have all lags."""
    return (model.transform(features).select("series_id", F.lit(family).alias("model"), "ds", "center", "scale",
                                             "z", F.col("prediction").alias("zhat")))


def importance(features: DataFrame, model, family: str, freq: str = "W-MON") -> DataFrame:
    """One row per feature; as many rows as features."""
    names = feature_names(lags_of(freq))
    values = [float(v) for v in model.featureImportances.toArray()]
    return features.sparkSession.createDataFrame(
        list(zip([family] * len(names), names, values)), "model string, feature string, importance double")
