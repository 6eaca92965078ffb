"""The common front of all jobs: facts to a scaled, split panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelcast.functions.calendar import future_array
from panelcast.models import smoothing
from panelcast.operators.grid import holdout_split, regularize
from panelcast.operators.scaling import robust_scale
from panelcast.schemas import HORIZON
from panelcast.sources import panels

SOURCES = {
    "priority": panels.orders_by_priority,
    "nation": panels.orders_by_nation,
    "supplier": panels.shipments_by_supplier,
}


def regular_panel(spark: SparkSession, folder: str, source: str = "supplier") -> DataFrame:
    return regularize(SOURCES[source](spark, folder))


def prepared_panel(spark: SparkSession, folder: str, source: str = "supplier") -> DataFrame:
    """``series_id, ds, y, center, scale, z, split``."""
    return prepare(regular_panel(spark, folder, source))


def prepare(panel: DataFrame, horizon: int = HORIZON) -> DataFrame:
    return holdout_split(robust_scale(panel), horizon)


def train_arrays(prepared: DataFrame) -> DataFrame:
    """One row per series: training dates and scaled values, scaler state."""
    train = prepared.where(F.col("split") == "train")
    points = F.sort_array(F.collect_list(F.struct("ds", "z")))
    return (train.groupBy("series_id", "center", "scale").agg(points.alias("_p"))
            .select("series_id", "center", "scale", F.col("_p.ds").alias("ds"), F.col("_p.z").alias("z")))


def all_arrays(prepared: DataFrame) -> DataFrame:
    """As ``train_arrays`` over all rows, for the refit before the future."""
    return train_arrays(prepared.withColumn("split", F.lit("train")))


def arrays_with_actuals(prepared: DataFrame) -> DataFrame:
    """``train_arrays`` with ``actuals``, the original values of all rows in date order, and ``last``, the last date.

    What is predicted from such rows meets its actuals inside the row: training
    rows come first and the calendar has no gaps, so positions tell dates.  The
    panel is computed once and nothing is joined.
    """
    points = F.sort_array(F.collect_list(F.struct("ds", "z", "y", "split")))
    rows = prepared.groupBy("series_id", "center", "scale").agg(points.alias("_p")) \
        .withColumn("_t", F.filter("_p", lambda p: p["split"] == "train")).where(F.size("_t") > 0)
    return rows.select("series_id", "center", "scale", F.col("_t.ds").alias("ds"), F.col("_t.z").alias("z"),
                       F.col("_p.y").alias("actuals"), F.element_at("_p.ds", -1).alias("last"))


def to_predictions(rows: DataFrame, freq: str = "W-MON", kind: str = "forecast",
                   fits: bool = True) -> DataFrame:
    """Arrays per series to long predictions in original units.

    ``fitted`` covers ``ds`` from position ``offset``; ``ahead`` continues the
    calendar after the last date.  ``lower`` and ``upper`` are optional.  Rows of
    ``arrays_with_actuals`` bring ``y`` and ``last`` along; ``y`` is NULL where no actual is known.
    """
    actual = F.col("actuals") if "actuals" in rows.columns else F.array().cast("array<double>")

    def points(dates, before, label, yhat, lower, upper):
        zipped = F.arrays_zip(dates.alias("ds"), yhat.alias("yhat"), lower.alias("lower"), upper.alias("upper"),
                              F.slice(actual, before + 1, F.size(dates)).alias("y"))
        return F.transform(zipped, lambda p: F.struct(
            p["ds"].alias("ds"), F.lit(label).alias("kind"), p["yhat"].alias("yhat"),
            p["lower"].alias("lower"), p["upper"].alias("upper"), p["y"].alias("y")))

    none = F.array().cast("array<double>")
    lower, upper = (F.coalesce(F.col(c), none) if c in rows.columns else none for c in ("lower", "upper"))
    ahead = points(future_array(F.element_at("ds", -1), F.size("ahead"), freq), F.size("ds"), kind, F.col("ahead"), lower, upper)
    if fits:
        before = F.col("offset") if "offset" in rows.columns else F.lit(0)
        ahead = F.concat(points(F.slice("ds", before + 1, F.size("ds")), before, "fitted", F.col("fitted"), none, none), ahead)
    keys, along = ["series_id", "model", "center", "scale"], ["last"] if "actuals" in rows.columns else []
    long = rows.select(*keys, *along, F.explode(ahead).alias("p"))
    back = lambda c: (F.col(f"p.{c}") * F.col("scale") + F.col("center")).alias(c)
    return long.select(*keys, "p.ds", "p.kind", back("yhat"), back("lower"), back("upper"),
                       *along, *[F.col("p.y") for _ in along])


def simple_smoothers(arrays: DataFrame) -> DataFrame:
    """Level-only and level-plus-trend smoothing with fixed weights, as rows.

    The two are exploded from the one row per series, so the panel behind the
    arrays is computed once.
    """
    spec = lambda model, trend, alpha, beta: F.struct(
        F.lit(model).alias("model"), F.lit(trend).alias("trend"), F.lit(alpha).alias("alpha"),
        F.lit(beta).alias("beta"), F.lit(0.0).alias("gamma"), F.lit(1.0).alias("phi"))
    both = F.array(spec("hw_simple", "none", 1 / 3, 0.0), spec("hw_trend", "add", 1 / 3, 1 / 30))
    return smoothing.start_values(arrays.select("*", F.explode(both).alias("s")).select("*", "s.*").drop("s"))


def smoothed_predictions(prepared: DataFrame, steps: int = HORIZON) -> DataFrame:
    """Fits and hold-out forecasts of the two fixed smoothers, beside their actuals ``y``."""
    rows = smoothing.smooth(simple_smoothers(arrays_with_actuals(prepared)))
    rows = rows.withColumn("ahead", smoothing.forecast_array(steps))
    return to_predictions(rows).drop("lower", "upper")

