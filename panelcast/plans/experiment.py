"""The whole experiment, and the future forecast of each series' winner."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, functions as F

from panelcast.models import trees
from panelcast.models.registry import FAMILIES
from panelcast.operators.evaluate import best_model, confidence_label, evaluate_models
from panelcast.operators.grid import assign_frequency, regularize
from panelcast.plans.prepare import all_arrays, prepare, to_predictions, train_arrays
from panelcast.schemas import HORIZON
from panelcast.session import materialize
from panelcast.sources.param_store import load_or_fit
from panelcast.sources.stores import (append_search_log, latest_best_params, read_search_log, search_log_rows,
                                      union_results)

# Candidates tried per family unless the caller says otherwise.
DEFAULT_DRAWS = {"gb": 20, "rf": 16, "svr": 20, "mlp": 12}
OTHER_DRAWS = 50

# The families of a default run; "ar", "hw", "bayes" and "ssm" are opt-in.
DEFAULT_FAMILIES = ("ets", "arima", "gb", "rf", "svr", "mlp", "prophet")
TREE_FAMILIES = ("gb", "rf")


@dataclass
class Experiment:
    """Tables of one run.  All but ``scores`` are written tables."""

    prepared: DataFrame
    best: DataFrame          # series_id, model, params, score
    predictions: DataFrame   # fits and hold-out forecasts, original units
    scores: DataFrame        # five metrics per series, model, phase
    failed: DataFrame        # series_id, model of families that no candidate could be fitted for


def _tree_run(prepared, arrays, family, steps, freq, n_iter, seed, params=None, kind="forecast", fits=True, store=None):
    """Train on the given rows and forecast; best params are the same for all series."""
    features = trees.feature_table(prepared, freq)
    if params is None and n_iter > 1:
        model, tried = trees.searched_trees(features, family, n_iter, seed=seed, store=store)
        params, score = max(tried, key=lambda p: p[1])
    else:
        params, score = params or trees.default_params(family), None
        model = trees.fit_trees(features, family, params, seed)
    ahead = to_predictions(trees.trees_forecast(arrays, model, family, steps, freq), freq, kind, fits=False)
    if fits:
        fitted = trees.trees_fitted(features, model, family).select(
            "series_id", "model", "center", "scale", "ds", F.lit("fitted").alias("kind"),
            (F.col("zhat") * F.col("scale") + F.col("center")).alias("yhat"),
            F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper"))
        ahead = fitted.unionByName(ahead)
    entries = [F.lit(x) for pair in params.items() for x in pair]
    best = arrays.select("series_id", F.lit(family).alias("model"), F.create_map(*entries).alias("params"),
                         F.lit(score).cast("double").alias("score"))
    return best, ahead


def run_experiment(panel: DataFrame, families: tuple[str, ...] = DEFAULT_FAMILIES, freq: str = "W-MON",
                   horizon: int = HORIZON, n_iter: int | None = None, seed: int = 0, store: str | None = None,
                   log: str | None = None, stamp: dt.datetime | None = None) -> Experiment:
    """Search, fit, forecast and score every family on every series.

    Families run one after another, each as jobs over the whole panel.  What
    more than one family reads is written once.  Searches go through the
    parameter store at ``store`` (by default the session's own): a run that is
    repeated, or that goes on after its driver was lost, fits only what no
    earlier run has fitted from the same values.  With ``log``, each family's
    winners are appended to the search log there under ``stamp`` (default now).
    """
    stamp = F.lit((stamp or dt.datetime.now()).strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    prepared = materialize(prepare(panel, horizon), "prepared")
    arrays = materialize(train_arrays(prepared), "train-arrays")
    bests, predictions, failed = [], [], []
    for name in families:
        draws = n_iter or DEFAULT_DRAWS.get(name, OTHER_DRAWS)
        if name in TREE_FAMILIES:
            best, rows = _tree_run(prepared.where("split = 'train'"), arrays, name, horizon, freq, draws, seed, store=store)
        else:
            family = FAMILIES[name]
            best = materialize(load_or_fit(arrays, name, (freq, draws, seed, family.version), partial(
                family.search, freq=freq, n_iter=draws, seed=seed), store), f"best-{name}")
            rows = to_predictions(family.predict(best, arrays, horizon, freq), freq)
        if log is not None:
            searched = best.select("series_id", "params", "score").join(
                arrays.select("series_id", F.size("z").alias("n_samples")), "series_id")
            append_search_log(search_log_rows(searched, stamp, name), log)
        failed.append(arrays.select("series_id", F.lit(name).alias("model"))
                      .join(best.select("series_id"), "series_id", "left_anti"))
        bests.append(best.select("series_id", "model", "params", "score"))
        predictions.append(materialize(rows.drop("center", "scale"), f"predictions-{name}"))
    merged = union_results(*predictions)
    scores = evaluate_models(prepared.select("series_id", "ds", "y"), merged)
    return Experiment(prepared, union_results(*bests), merged, scores, union_results(*failed))


def run_by_frequency(panel: DataFrame, config: DataFrame, skip_odd: bool = False, **options) -> dict[str, Experiment]:
    """One experiment per frequency in use, for panels that mix frequencies.

    A series whose step is none the calendar knows (every second week, say) and
    that is not configured stops the run; with ``skip_odd`` it is left out.

    The loop is over the few frequencies a calendar knows, never over series.
    """
    assigned = materialize(assign_frequency(panel, config), "frequencies")
    odd = assigned.where("freq IS NULL").agg(F.count("*"), F.min("series_id")).first()
    if odd[0] and not skip_odd:
        raise ValueError(f"{odd[0]} series have a step of no known frequency, such as {odd[1]}; configure them")
    runs = {}
    for (freq,) in assigned.where("freq IS NOT NULL").select("freq").distinct().collect():
        mine = panel.join(assigned.where(F.col("freq") == freq).select("series_id"), "series_id", "left_semi")
        runs[freq] = run_experiment(regularize(mine, freq), freq=freq, **options)
    return runs


def with_logged_params(winners: DataFrame, log: str) -> DataFrame:
    """``winners`` with the newest logged parameters and score of their series and model, where there are any."""
    newest = latest_best_params(read_search_log(winners.sparkSession, log), keep_null=True).select(
        "dataset", F.col("best_params").alias("logged"), F.col("best_score").alias("logged_score"))
    rows = winners.withColumn("dataset", F.concat_ws("_", "series_id", "model")).join(newest, "dataset", "left")
    found = F.col("logged").isNotNull()
    return rows.select("series_id", "model", F.when(found, F.col("logged")).otherwise(F.col("params")).alias("params"),
                       F.when(found, F.col("logged_score")).otherwise(F.col("score")).alias("score"))


def future_forecast_best(run: Experiment, periods: int = HORIZON, freq: str = "W-MON", alpha: float = 0.05,
                         seed: int = 0, log: str | None = None) -> DataFrame:
    """Refit each series' best model on all its rows and forecast past the end.

    Series are routed to the family that won for them; families without bands
    give points only, with no confidence label.  With ``log``, the refit takes
    the newest logged parameters instead of the run's own.
    """
    won = (best_model(run.scores).join(run.best, "series_id").where("model = best_model")
           .select("series_id", "model", "params", "score"))
    winners = materialize(won if log is None else with_logged_params(won, log), "winners")
    arrays = all_arrays(run.prepared)
    parts = []
    for name in [row[0] for row in winners.select("model").distinct().collect()]:
        chosen = winners.where(F.col("model") == name)
        mine = arrays.join(chosen.select("series_id"), "series_id", "left_semi")
        if name in TREE_FAMILIES:
            # One global model per family: its parameters are those of any series.
            params = dict(chosen.select("params").first()[0])
            everything = run.prepared.withColumn("split", F.lit("train"))
            _, rows = _tree_run(everything, mine, name, periods, freq, 1, seed, params, "future", fits=False)
        else:
            best = chosen.withColumn("coef", F.lit(None).cast("array<double>"))
            rows = to_predictions(FAMILIES[name].predict(best, mine, periods, freq, alpha, refit_rows=True),
                                  freq, "future", fits=False)
            if not FAMILIES[name].has_bands:
                rows = rows.withColumns({c: F.lit(None).cast("double") for c in ("lower", "upper")})
        parts.append(rows.drop("center", "scale"))
    label = F.when(F.col("lower").isNotNull(), confidence_label(F.col("yhat"), F.col("lower"), F.col("upper")))
    return union_results(*parts).withColumn("confidence", label)
