"""Forecast error measures as aggregate expressions over ``(y, yhat)``.

A metric is a function ``(y, yhat) -> Column`` returning an aggregate, so any
number of them is computed in one grouped pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

Metric = Callable[[Column, Column], Column]


def mape(y: Column, yhat: Column) -> Column:
    """Mean of |error| over the *signed* actual; NULL when an actual is 0."""
    ratio = F.abs(y - yhat) / F.when(y != 0, y)
    return F.when(F.count_if(y == 0) == 0, F.round(F.avg(ratio), 2))


def smape(y: Column, yhat: Column) -> Column:
    half_sum = (F.abs(y) + F.abs(yhat)) / 2
    return F.round(F.avg(F.when(half_sum != 0, F.abs(y - yhat) / F.when(half_sum != 0, half_sum))
                         .otherwise(F.when(half_sum == 0, 0.0))), 2)


def cumulative_error_percentage(y: Column, yhat: Column) -> Column:
    total = F.abs(F.sum(y))
    return F.round(F.abs(F.sum(y) - F.sum(yhat)) / F.when(total != 0, total), 2)


def weighted_mape(y: Column, yhat: Column) -> Column:
    """Errors weighted by |actual|; NULL when an actual is 0."""
    weight = F.sum(F.abs(y))
    value = F.sum(F.abs(y - yhat)) / F.when(weight != 0, weight)
    return F.when(F.count_if(y == 0) == 0, F.round(value, 2))


def value_weighted_error(y: Column, yhat: Column) -> Column:
    squares = F.sum(y * y)
    return F.sum(F.abs(y - yhat) * F.abs(y)) / F.when(squares != 0, squares)


def error_std(y: Column, yhat: Column) -> Column:
    return F.stddev_pop(y - yhat)


def rmse(y: Column, yhat: Column) -> Column:
    return F.sqrt(F.avg(F.pow(y - yhat, 2)))


def training_mape(y: Column, yhat: Column) -> Column:
    """Error on scaled values with a floored absolute denominator."""
    floor = 2.220446049250313e-16  # double machine epsilon
    return F.avg(F.abs(y - yhat) / F.greatest(F.abs(y), F.lit(floor)))


# The five measures of the leaderboard, in export order.
METRICS: dict[str, Metric] = {
    "mape": mape,
    "smape": smape,
    "cumulative_error_percentage": cumulative_error_percentage,
    "weighted_mape": weighted_mape,
    "error_std": error_std,
}


def register_metric(name: str, metric: Metric) -> None:
    """Add a metric; ``evaluate_models(..., metrics=[name])`` can then use it."""
    EXTRA[name] = metric


EXTRA: dict[str, Metric] = {
    "value_weighted_error": value_weighted_error,
    "rmse": rmse,
    "training_mape": training_mape,
}


def resolve(names: list[str] | None) -> dict[str, Metric]:
    if names is None:
        return dict(METRICS)
    known = {**METRICS, **EXTRA}
    return {name: known[name] for name in names}
