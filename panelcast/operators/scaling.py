"""Robust scaling: centre on the median, divide by the interquartile range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelcast.operators.grid import whole


def _stats(quartiles: Column) -> tuple[Column, Column]:
    spread = quartiles[2] - quartiles[0]
    return quartiles[1], F.when(spread == 0, F.lit(1.0)).otherwise(spread)


def _quartiles() -> Column:
    return F.percentile("y", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))


def robust_scale_fit(panel: DataFrame, fit_on: str = "all") -> DataFrame:
    """``scale_stats(series_id, center, scale)``; exact, linear interpolation.

    ``fit_on='all'`` uses every row, hold-out included; ``'train'`` only rows
    marked so by ``holdout_split``.
    """
    rows = panel if fit_on == "all" else panel.where(F.col("split") == "train")
    center, scale = _stats(F.col("q"))
    return (rows.groupBy("series_id").agg(_quartiles().alias("q"))
            .select("series_id", center.alias("center"), scale.alias("scale")))


def apply_scale_stats(panel: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach each series' scaler by an equi-join on ``series_id``."""
    return panel.join(stats, "series_id")


def robust_scale_transform(panel: DataFrame) -> DataFrame:
    return panel.withColumn("z", (F.col("y") - F.col("center")) / F.col("scale"))


def robust_scale_inverse(df: DataFrame, *columns: str) -> DataFrame:
    """Back to original units, in place, for the named scaled columns."""
    return df.withColumns({c: F.col(c) * F.col("scale") + F.col("center") for c in columns})


def robust_scale(panel: DataFrame) -> DataFrame:
    """Fit and transform in one pass over the already partitioned panel.

    Equal to fit + apply + transform on all rows, without reading the panel
    twice or joining the statistics back.
    """
    center, scale = _stats(F.col("_q"))
    return robust_scale_transform(
        panel.withColumn("_q", _quartiles().over(whole()))
        .withColumns({"center": center, "scale": scale}).drop("_q"))
