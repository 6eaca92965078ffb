"""Local-level state space on arrays: filter, steady state, smoother, forecast.

The level follows ``a' = a + noise(q)`` and is observed as ``y = a + noise(h)``.
All of it is JVM expressions over the ordered array of a series.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from panelcast.functions.recursions import let, scan, stepped
from panelcast.schemas import JITTER

STEP = ("struct<a_pred:double,p_pred:double,v:double,f:double,a_filt:double,"
        "p_filt:double,loglik:double>")
LOG_2PI = math.log(2 * math.pi)


NAMES = ["a_pred", "p_pred", "v", "f", "a_filt", "p_filt", "loglik"]


def update(a: Column, p: Column, y: Column, h: Column) -> Column:
    """One observation: prediction in, a ``STEP`` row out.

    A missing ``y`` leaves the prediction as it is and adds no likelihood.
    """
    def correct(w: Column) -> Column:
        v, f = w["v"], w["f"]
        gain = p / f
        kept = (1 - gain) * (1 - gain) * p + gain * gain * h
        made = {"a_pred": a, "p_pred": p, "v": v, "f": f, "a_filt": F.coalesce(a + gain * v, a),
                "p_filt": F.when(v.isNull(), p).otherwise(kept) + JITTER,
                "loglik": F.coalesce(-0.5 * (LOG_2PI + F.log(f) + v * v / f), F.lit(0.0))}
        return F.struct(*[made[n].alias(n) for n in NAMES])
    return let(F.struct((y - a).alias("v"), (p + h + JITTER).alias("f")), correct)


def filter_array(y: Column, q: Column, h: Column, a0: Column, p0: Column) -> Column:
    """Array of ``STEP`` rows, one per element of ``y``."""
    def step(state: Column, value: Column) -> Column:
        return let(update(state["a"], state["p"], value, h), lambda row: stepped(
            F.struct(row["a_filt"].alias("a"), (row["p_filt"] + q).alias("p")), row))
    zero = F.struct(a0.cast("double").alias("a"), p0.cast("double").alias("p"))
    return scan(y, zero, step, STEP)["out"]


def steady_variance(q: Column, h: Column) -> Column:
    """Prediction variance the filter converges to (scalar Riccati equation)."""
    return (q + F.sqrt(q * q + 4 * q * h)) / 2


def steady_array(y: Column, q: Column, h: Column, a0: Column) -> Column:
    """Filter with the constant gain; same rows as ``filter_array``."""
    p = steady_variance(q, h)
    f = p + h
    gain = p / f

    def step(a: Column, value: Column) -> Column:
        v = value - a
        a_filt = F.coalesce(a + gain * v, a)
        loglik = F.coalesce(-0.5 * (LOG_2PI + F.log(f) + v * v / f), F.lit(0.0))
        row = {"a_pred": a, "p_pred": p, "v": v, "f": f, "a_filt": a_filt,
               "p_filt": p * (1 - gain), "loglik": loglik}
        return stepped(a_filt, F.struct(*[c.alias(n) for n, c in row.items()]))
    return scan(y, a0.cast("double"), step, STEP)["out"]


def smoother_array(filtered: Column, q: Column) -> Column:
    """Backward pass over ``filter_array``; ``struct<a_smooth, p_smooth>`` rows."""
    last = F.element_at(filtered, -1)
    zero = F.struct(last["a_filt"].alias("a"), last["p_filt"].alias("p"))

    def step(state: Column, row: Column) -> Column:
        p_hat = row["p_filt"] + q + JITTER
        gain = row["p_filt"] / p_hat
        a = row["a_filt"] + gain * (state["a"] - row["a_filt"])
        p = row["p_filt"] + gain * gain * (state["p"] - p_hat)
        out = F.struct(a.alias("a_smooth"), p.alias("p_smooth"))
        return stepped(F.struct(a.alias("a"), p.alias("p")), out)
    earlier = F.reverse(F.slice(filtered, 1, F.size(filtered) - 1))
    backward = scan(earlier, zero, step, "struct<a_smooth:double,p_smooth:double>")["out"]
    end = F.array(F.struct(last["a_filt"].alias("a_smooth"), last["p_filt"].alias("p_smooth")))
    return F.concat(F.reverse(backward), end)
