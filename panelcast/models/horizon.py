"""Forecasts of a state-space model from any date, by expressions on a table of states.

The states of all dates (``kf_states``) are a table; a forecast looks up the last
state at or before its start and needs no other pass over the series.  Powers of
the transition do not depend on the series, so they form a small table by step
that is joined; means and variances are then sums over arrays inside the JVM.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from panelcast.functions.calendar import grid_date, ordinal
from panelcast.functions.recursions import normal_quantile
from panelcast.models.statespace import build


def _power(step: np.ndarray, c: np.ndarray, q: np.ndarray, k: int):
    """``k`` steps at once by repeated squaring: transition, constant and variance gathered on the way."""
    m = len(step)
    out = (np.eye(m), np.zeros(m), np.zeros((m, m)))
    base = (step, c, q)
    after = lambda x, y: (y[0] @ x[0], y[0] @ x[1] + y[1], y[0] @ x[2] @ y[0].T + y[2])
    while k:
        if k & 1:
            out = after(out, base)
        base, k = after(base, base), k >> 1
    return out


def horizon_table(spark, components: list[dict], first: int, last: int) -> DataFrame:
    """``ahead, weights, constant, spread`` for the steps ``first`` to ``last``.

    The observation ``ahead`` steps after a state (a, P) has the mean
    ``weights . a + constant`` and the variance ``weights P weights + spread``.
    """
    system = build(json.dumps(components))
    step, z = system["T"], system["Z"]
    power, c, q = _power(step, system["c"], system["Q"], first)
    rows = []
    for k in range(first, last + 1):
        rows.append((k, (z @ power).tolist(), float(z @ c + system["d"]), float(z @ q @ z + system["H"])))
        power, c, q = step @ power, step @ c + system["c"], step @ q @ step.T + system["Q"]
    return spark.createDataFrame(rows, "ahead int, weights array<double>, constant double, spread double")


def states_at(states: DataFrame, starts: DataFrame) -> DataFrame:
    """The last state of each series at or before its ``start``: ``series_id, start, at, state, cov``.

    ``starts`` has ``series_id, start``; a series may have several.  Series whose
    first state is later than the start give no row.
    """
    met = states.join(starts, "series_id").where(F.col("ds") <= F.col("start"))
    return (met.groupBy("series_id", "start").agg(F.max_by(F.struct("ds", "state", "cov"), "ds").alias("s"))
            .select("series_id", "start", F.col("s.ds").alias("at"), "s.state", "s.cov"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, v: total + v)


def forecast_from(states: DataFrame, components: list[dict], starts: DataFrame, freq: str = "W-MON",
                  periods: int | None = None, end=None, exog: DataFrame | None = None, alpha: float = 0.05) -> DataFrame:
    """Observations after ``start``: ``series_id, start, step, ds, mean, var, lower, upper``.

    ``states`` are rows of one kind of ``kf_states`` of the same ``components``.
    Forecasts begin at the first grid date after ``start`` and go on for
    ``periods`` dates, or up to ``end`` (a date or its text, itself included);
    exactly one of the two is given.  A start between or after the dates of a
    series goes on from its last state before it, whatever the distance.  With
    regressors, ``exog`` holds their future values, ``series_id, ds, x
    (array)``; a date without them has NULL mean and variance.
    """
    if (periods is None) == (end is None):
        raise ValueError("give exactly one of periods and end")
    system = build(json.dumps(components))
    here = system["exog"]
    if (here is None) != (exog is None):
        raise ValueError("future regressors are needed by a regression component, and by no other")
    found = states_at(states, starts).withColumn("from", ordinal(F.col("start"), freq))
    last = F.col("from") + periods if end is None else ordinal(F.lit(end).cast(states.schema["ds"].dataType), freq)
    found = found.withColumns({"last": last, "own": ordinal(F.col("at"), freq)}).where("last > from")
    dates = found.select("*", F.explode(F.sequence(F.col("from") + 1, F.col("last"))).alias("number"))
    dates = dates.select("series_id", "start", "state", "cov", (F.col("number") - F.col("from")).cast("int").alias("step"),
                         (F.col("number") - F.col("own")).cast("int").alias("ahead"), grid_date(F.col("number"), freq).alias("ds"))
    # The reach of the table: two numbers, from the dates of the states alone.
    low, high = found.agg(F.min(F.col("from") - F.col("own")), F.max(F.col("last") - F.col("own"))).first()
    rows = dates.join(horizon_table(states.sparkSession, components, *((1, 0) if low is None else (low + 1, high))), "ahead")
    if here is not None:
        q = np.diag(system["Q"])[here]
        rows = rows.join(exog.select("series_id", "ds", "x"), ["series_id", "ds"], "left")
        m, first, width = len(system["Z"]), here.start, here.stop - here.start
        x = F.when(F.size("x") == width, F.col("x"))
        # Coefficients stay as they are or drift: their weights are the regressors themselves.
        rows = rows.withColumns({
            "spread": F.col("spread") + F.col("ahead") * _dot(F.transform(x, lambda v: v * v), F.array(*[F.lit(float(v)) for v in q])),
            "weights": F.concat(F.slice("weights", 1, first), x, F.slice("weights", first + width + 1, m)) if m > width else x})
    m = len(system["Z"])
    mean = _dot(F.col("weights"), F.col("state")) + F.col("constant")
    through = F.transform("weights", lambda w, i: w * _dot(F.col("weights"), F.slice("cov", i * m + 1, m)))
    out = rows.select("series_id", "start", "step", "ds", mean.alias("mean"),
                      (F.aggregate(through, F.lit(0.0), lambda total, v: total + v) + F.col("spread")).alias("var"))
    reach = normal_quantile(alpha) * F.sqrt("var")
    return out.withColumns({"lower": F.col("mean") - reach, "upper": F.col("mean") + reach})
