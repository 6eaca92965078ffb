"""Recursions over ordered arrays, evaluated inside the JVM."""

from __future__ import annotations

from collections.abc import Callable
from statistics import NormalDist

from pyspark.sql import Column, functions as F


def scan(values: Column, zero: Column, step: Callable[[Column, Column], Column],
         emit_type: str) -> Column:
    """Fold over ``values`` keeping the state and one output per element.

    ``step(state, value)`` returns a struct of the next ``state`` and the
    output ``out``.  The result is ``struct<state, out array>``; ``emit_type``
    is the type of one output.

    An appended array is copied, so outputs are gathered in runs of about the
    square root of the length, and the runs in one array: an output is copied
    as often as its run is long, not as often as the series.
    """
    def folded(rows: Column, state: Column, take: Callable[[Column, Column], Column], out_type: str) -> Column:
        start = F.struct(state.alias("state"), F.array().cast(f"array<{out_type}>").alias("out"))
        return F.aggregate(rows, start, lambda acc, row: let(take(acc["state"], row), lambda made: F.struct(
            made["state"].alias("state"), F.concat(acc["out"], F.array(made["out"])).alias("out"))))

    def by_runs(rows: Column) -> Column:
        run = F.greatest(F.ceil(F.sqrt(F.size(rows))), F.lit(1)).cast("int")
        starts = F.sequence(F.lit(1), F.greatest(F.size(rows), F.lit(1)), run)
        runs = F.transform(starts, lambda first: F.slice(rows, first, run))
        return let(folded(runs, zero, lambda state, some: folded(some, state, step, emit_type), f"array<{emit_type}>"),
                   lambda made: F.struct(made["state"].alias("state"), F.flatten(made["out"]).alias("out")))

    return let(values, by_runs)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    Inside a lambda nothing else stops a repeated sub-expression from being
    evaluated at every place it is used.
    """
    return F.transform(F.array(value), body)[0]


def normal_quantile(alpha: float) -> float:
    """Two-sided standard normal quantile."""
    return NormalDist().inv_cdf(1 - alpha / 2)


def stepped(state: Column, out: Column) -> Column:
    """What a step of ``scan`` returns."""
    return F.struct(state.alias("state"), out.alias("out"))


def sum_of(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def damped_sum(phi: Column, h: Column) -> Column:
    """phi + phi^2 + ... + phi^h."""
    return F.aggregate(F.sequence(F.lit(1), h), F.lit(0.0), lambda a, i: a + F.pow(phi, i))
