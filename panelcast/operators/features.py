"""Lag and calendar features of the regression forecasters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelcast.functions.calendar import calendar_columns, future_array, lags_of
from panelcast.operators.grid import by_date

CALENDAR_NAMES = ["month", "day_of_week", "day_of_month", "is_weekend"]


def feature_names(lags: list[int]) -> list[str]:
    return [f"lag_{k}" for k in lags] + CALENDAR_NAMES


def calendar_features(panel: DataFrame) -> DataFrame:
    return panel.withColumns(calendar_columns(F.col("ds")))


def lag_features(panel: DataFrame, freq: str = "W-MON", value: str = "z",
                 lags: list[int] | None = None, keep_incomplete: bool = False) -> DataFrame:
    """``lag_k`` for each lag of the frequency, then the calendar columns.

    All lags share one window.  Rows that lack a lag are dropped.
    """
    lags = lags or lags_of(freq)
    names = [f"lag_{k}" for k in lags]
    out = panel.withColumns({f"lag_{k}": F.lag(value, k).over(by_date()) for k in lags})
    out = calendar_features(out)
    return out if keep_incomplete else out.dropna(subset=names)


def lag_from_end(history: Column, k: int) -> Column:
    """k-th value from the end of an array, 0 where it is shorter."""
    return F.when(F.size(history) >= k, F.element_at(history, -k)).otherwise(F.lit(0.0))


def forecast_step_features(arrays: DataFrame, freq: str = "W-MON", value: str = "z",
                           lags: list[int] | None = None) -> DataFrame:
    """Features of the first step past the end of each series.

    ``arrays`` is one row per series, see ``as_arrays``.
    """
    lags = lags or lags_of(freq)
    next_ds = F.element_at(future_array(F.element_at("ds", -1), 1, freq), 1)
    out = arrays.select("series_id", next_ds.alias("ds"),
                        *[lag_from_end(F.col(value), k).alias(f"lag_{k}") for k in lags])
    return calendar_features(out)


def recursive_forecast(weights: Column, intercept: Column, lags: list[int],
                       steps: int, value: str = "z") -> Column:
    """Forecast array of a linear lag model: predict, append, repeat.

    The history array grows by one value per step inside ``aggregate``; no
    Python is involved.
    """
    def grow(history: Column, _: Column) -> Column:
        point = intercept
        for i, k in enumerate(lags):
            point = point + weights[i] * lag_from_end(history, k)
        return F.concat(history, F.array(point))

    longest = max(lags)
    start = F.slice(F.col(value), F.greatest(F.size(value) - longest + 1, F.lit(1)), longest)
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, grow,
                       lambda h: F.slice(h, F.size(h) - steps + 1, steps))
