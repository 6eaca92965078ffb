"""Scoring forecasts, ranking models, labelling confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelcast.functions.metrics import resolve


def known(rows: DataFrame) -> DataFrame:
    """Rows with an actual ``y``."""
    return rows.where(F.col("y").isNotNull() & ~F.isnan("y"))


def align_actual_forecast(actuals: DataFrame, predictions: DataFrame) -> DataFrame:
    """Pair predictions with actuals of the same series and date.

    Actuals with a missing value are left out.
    """
    return predictions.drop("y").join(known(actuals).select("series_id", "ds", "y"), ["series_id", "ds"])


def score(aligned: DataFrame, metrics: list[str] | None = None,
          keys: tuple[str, ...] = ("series_id", "model", "phase")) -> DataFrame:
    """All metrics in one grouped aggregation."""
    y, yhat = F.col("y"), F.col("yhat")
    return aligned.groupBy(*keys).agg(
        *[metric(y, yhat).alias(name) for name, metric in resolve(metrics).items()])


def evaluate_models(actuals: DataFrame | None, predictions: DataFrame,
                    metrics: list[str] | None = None) -> DataFrame:
    """Leaderboard over training fits and hold-out forecasts.

    Only rows with a prediction count, so a lag model is scored on the rows
    that had all their lags.  Without ``actuals`` the predictions' own ``y`` counts.
    """
    phase = F.when(F.col("kind") == "fitted", "training").otherwise("testing")
    usable = predictions.where(F.col("kind").isin("fitted", "forecast") & F.col("yhat").isNotNull())
    usable = usable.withColumn("phase", phase)
    return score(known(usable) if actuals is None else align_actual_forecast(actuals, usable), metrics)


def argmin_model(scores: DataFrame, by: str = "weighted_mape") -> DataFrame:
    """The single row with the smallest score, model name breaking ties."""
    row = F.struct(*scores.columns)
    return (scores.where(F.col(by).isNotNull())
            .agg(F.min_by(row, F.struct(by, "model", "series_id")).alias("r")).select("r.*"))


def best_model(scores: DataFrame, by: str = "weighted_mape") -> DataFrame:
    """Per series the model with the smallest hold-out score.

    A score that no model of a series has (a relative error against an actual
    of 0) is replaced by those that exist, ``smape`` and then ``error_std``, so
    that no series goes without a winner; its ``by`` is then NULL.
    """
    held_out = scores.where(F.col("phase") == "testing")
    order = [F.isnull(by).alias("none"), F.col(by)]
    for other in ("smape", "error_std"):
        if other != by and other in scores.columns:
            fallback = F.when(F.isnull(by), F.col(other))
            order += [F.isnull(fallback).alias(f"no_{other}"), fallback.alias(f"by_{other}")]
    return (held_out.groupBy("series_id")
            .agg(F.min_by(F.struct(F.col("model"), F.col(by)), F.struct(*order, "model")).alias("b"))
            .select("series_id", F.col("b.model").alias("best_model"), F.col(f"b.{by}").alias(by)))


def rank_models(scores: DataFrame, by: str = "weighted_mape") -> DataFrame:
    """Rank within each series and phase; groups hold one row per model."""
    w = Window.partitionBy("series_id", "phase").orderBy(F.col(by).asc_nulls_last(), "model")
    return scores.withColumn("rank", F.rank().over(w))


def confidence_label(yhat: Column, lower: Column, upper: Column) -> Column:
    """Band width relative to |forecast|: below .2 high, below .4 medium."""
    width = (upper - lower) / F.when(yhat != 0, F.abs(yhat))
    return F.when(width < 0.2, "high").when(width < 0.4, "medium").otherwise("low")


def running_abs_pct_error(aligned: DataFrame) -> DataFrame:
    """Running mean of the absolute percentage error, each capped at 100."""
    error = F.abs((F.col("y") - F.col("yhat")) / F.when(F.col("y") != 0, F.col("y"))) * 100
    # An error against an actual of 0 is unbounded, hence at the cap.
    capped = F.when((F.col("y") == 0) & (F.col("yhat") != 0), 100.0).otherwise(F.least(F.lit(100.0), error))
    w = (Window.partitionBy("series_id", "model").orderBy("ds")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return aligned.withColumn("running_error", F.avg(capped).over(w))


def default_view_window(backtest: DataFrame, future: DataFrame) -> DataFrame:
    """Start and end date of the default display per series.

    Start: the middle back-test row.  End: the last future row labelled high
    or medium, or the row a quarter into the future when a level is absent.
    """
    by_date = Window.partitionBy("series_id").orderBy("ds")
    whole = Window.partitionBy("series_id")
    start = (backtest.select("series_id", "ds", (F.row_number().over(by_date) - 1).alias("i"),
                             F.count("*").over(whole).alias("n"))
             .where(F.col("i") == F.floor(F.col("n") / 2))
             .select("series_id", F.col("ds").alias("view_start")))
    numbered = future.select("series_id", "ds", "confidence",
                             (F.row_number().over(by_date) - 1).alias("i"), F.count("*").over(whole).alias("n"))
    end = numbered.groupBy("series_id").agg(
        F.count_if(F.col("confidence") == "high").alias("highs"),
        F.count_if(F.col("confidence") == "medium").alias("mediums"),
        F.max(F.when(F.col("confidence").isin("high", "medium"), F.col("ds"))).alias("labelled"),
        F.max(F.when(F.col("i") == F.floor(F.col("n") / 4), F.col("ds"))).alias("quarter"))
    limited = (F.col("highs") == 0) | (F.col("mediums") == 0)
    return start.join(end, "series_id").select(
        "series_id", "view_start", F.when(limited, F.col("quarter")).otherwise(F.col("labelled")).alias("view_end"),
        limited.alias("limited_confidence"))
