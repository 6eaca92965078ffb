"""Linear Gaussian state space on panels: filter, smoother, decomposition.

A model is a list of components (plain dicts); its matrices are built inside
the tasks.  Covariances and gains do not depend on the data, only on which
rows are missing.  So series of a batch that share a missing pattern share one
covariance pass, and their means advance together as one matrix.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelcast.functions.calendar import future_array
from panelcast.functions.recursions import normal_quantile
from panelcast.operators.grid import by_date
from panelcast.operators.search import explode_grid, fit_candidates, pick_best_candidate
from panelcast.schemas import JITTER

# --- components ---------------------------------------------------------------


def level_trend(order: int = 2, sigma: tuple[float, ...] | float = 0.1, start: float = 1.0,
                innovations: list[int] | None = None) -> dict:
    """Level and its derivatives; ``innovations`` masks which are disturbed."""
    sigmas = [float(sigma)] * order if np.isscalar(sigma) else [float(s) for s in sigma]
    mask = innovations or [1] * order
    return {"name": "trend", "kind": "level", "order": order, "p0": start,
            "sigma": [s * m for s, m in zip(sigmas, mask)]}


def noise(sigma: float = 1.0) -> dict:
    return {"name": "noise", "kind": "noise", "sigma": float(sigma)}


def autoregressive(rho: list[float], sigma: float = 0.1, mask: list[int] | None = None) -> dict:
    """AR of the lags where ``mask`` is 1; ``rho`` lists those coefficients."""
    full = [0.0] * len(mask or rho)
    values = iter(rho)
    for i, m in enumerate(mask or [1] * len(rho)):
        full[i] = next(values) if m else 0.0
    return {"name": "ar", "kind": "ar", "rho": full, "sigma": float(sigma), "p0": 1.0}


def season_dummy(season: int, sigma: float = 0.0) -> dict:
    return {"name": f"season_{season}", "kind": "dummy", "season": season, "sigma": float(sigma), "p0": 1.0}


def season_fourier(season: float, n: int | None = None, sigma: float = 0.0) -> dict:
    return {"name": f"fourier_{season}", "kind": "fourier", "season": season, "p0": 1.0,
            "n": n or int(season // 2), "sigma": float(sigma)}


def cycle(length: float, damping: float = 1.0, sigma: float = 0.1) -> dict:
    return {"name": "cycle", "kind": "cycle", "length": float(length), "damping": float(damping),
            "sigma": float(sigma), "p0": 1.0}


def regression(columns: int, sigma: float = 0.0) -> dict:
    """Coefficients of ``columns`` regressors; they drift when ``sigma`` > 0."""
    return {"name": "regression", "kind": "regression", "columns": columns, "sigma": float(sigma), "p0": 10.0}


def intercepts(c: list[float] | None = None, d: float = 0.0) -> dict:
    """Constants of the model: ``c`` enters every next state (one value per
    state, in the order of the other components), ``d`` every observation."""
    return {"name": "intercepts", "kind": "intercepts", "c": [float(v) for v in c or []], "d": float(d), "sigma": 0.0}


def _rotation(angle, damping=1.0):
    return damping * np.array([[np.cos(angle), np.sin(angle)], [-np.sin(angle), np.cos(angle)]])


def _blocks(spec):
    """Transition, observation row and noise variances of one component."""
    kind, sigma = spec["kind"], spec["sigma"]
    if kind == "level":
        k = spec["order"]
        return np.triu(np.ones((k, k))), np.eye(k)[0], np.square(sigma)
    if kind == "ar":
        k = len(spec["rho"])
        step = np.eye(k, k=-1)
        step[0] = spec["rho"]
        return step, np.eye(k)[0], np.r_[sigma ** 2, np.zeros(k - 1)]
    if kind == "dummy":
        k = int(spec["season"]) - 1
        step = np.eye(k, k=-1)
        step[0] = -1.0
        return step, np.eye(k)[0], np.r_[sigma ** 2, np.zeros(k - 1)]
    if kind == "fourier":
        n, step = spec["n"], np.zeros((2 * spec["n"], 2 * spec["n"]))
        for j in range(1, n + 1):
            step[2 * j - 2:2 * j, 2 * j - 2:2 * j] = _rotation(2 * np.pi * j / spec["season"])
        return step, np.tile([1.0, 0.0], n), np.full(2 * n, sigma ** 2)
    if kind == "cycle":
        return (_rotation(2 * np.pi / spec["length"], spec["damping"]), np.array([1.0, 0.0]), np.full(2, sigma ** 2))
    k = spec["columns"]
    return np.eye(k), np.zeros(k), np.full(k, sigma ** 2)


@functools.lru_cache(maxsize=256)
def build(text: str) -> dict:
    """Matrices of a component list given as JSON; names may not repeat."""
    specs = json.loads(text)
    names = [s["name"] for s in specs]
    if len(set(names)) < len(names):
        raise ValueError(f"component names repeat: {names}")
    h = sum(s["sigma"] ** 2 for s in specs if s["kind"] == "noise")
    states = [s for s in specs if s["kind"] not in ("noise", "intercepts")]
    parts = [_blocks(s) for s in states]
    m = sum(len(z) for _, z, _ in parts)
    step, q, z, p0, slices, at = np.zeros((m, m)), np.zeros(m), np.zeros(m), np.zeros(m), {}, 0
    exog = None
    for spec, (t, row, var) in zip(states, parts):
        here = slice(at, at + len(row))
        step[here, here], z[here], q[here], p0[here] = t, row, var, spec["p0"]
        slices[spec["name"]] = here
        if spec["kind"] == "regression":
            exog = here
        at += len(row)
    c, d = np.zeros(m), 0.0
    for spec in specs:
        if spec["kind"] == "intercepts":
            c, d = (np.array(spec["c"]) if spec["c"] else c), spec["d"]
            if len(c) != m:
                raise ValueError(f"{len(c)} state intercepts for {m} states")
    return {"T": step, "Z": z, "Q": np.diag(q), "H": h, "P0": np.diag(p0), "slices": slices, "exog": exog, "c": c, "d": d}


PART_BYTES = 32 << 20

# --- passes -----------------------------------------------------------------------

def _covariances(system, seen, rows=None):
    """Gains and covariances for one missing pattern (``seen`` is True where
    observed).  ``rows`` are time-varying observation vectors."""
    step, q, h, n = system["T"], system["Q"], system["H"], len(seen)
    m = len(step)
    eye, cov = np.eye(m), system["P0"].copy()
    out = {"P_pred": np.empty((n, m, m)), "P_filt": np.empty((n, m, m)), "K": np.zeros((n, m)), "F": np.empty(n)}
    for t in range(n):
        z = system["Z"] if rows is None else rows[t]
        out["P_pred"][t] = cov
        pz = cov @ z
        f = out["F"][t] = z @ pz + h + JITTER
        if seen[t]:
            k = out["K"][t] = pz / f
            keep = eye - np.outer(k, z)
            cov = keep @ cov @ keep.T + h * np.outer(k, k)
        cov = (cov + cov.T) / 2 + JITTER * eye
        out["P_filt"][t] = cov
        cov = step @ cov @ step.T + q
    out["P_next"] = cov
    return out


def _means(system, cov, y, rows=None, start=None):
    """Filtered and predicted means of several series (``y`` is B x n)."""
    b, n = y.shape
    a = np.zeros((b, len(system["T"]))) if start is None else np.tile(start, (b, 1))
    out = {"a_pred": np.empty((n, *a.shape)), "a_filt": np.empty((n, *a.shape)), "v": np.zeros((b, n))}
    seen = ~np.isnan(y[0])
    for t in range(n):
        z = system["Z"] if rows is None else rows[t]
        out["a_pred"][t] = a
        if seen[t]:
            v = out["v"][:, t] = y[:, t] - a @ z - system["d"]
            a = a + v[:, None] * cov["K"][t]
        out["a_filt"][t] = a
        a = a @ system["T"].T + system["c"]
    out["a_next"] = a
    f = cov["F"]
    out["loglik"] = np.where(seen, -0.5 * (np.log(2 * np.pi) + np.log(f) + out["v"] ** 2 / f), 0.0)
    return out


def _smooth(system, cov, means):
    """Backward pass; the gains are shared by all series of the pattern."""
    step, n = system["T"], len(cov["F"])
    a, p = means["a_filt"].copy(), cov["P_filt"].copy()
    eye = JITTER * np.eye(len(step))
    for t in range(n - 2, -1, -1):
        p_hat = step @ cov["P_filt"][t] @ step.T + system["Q"] + eye
        gain = (np.linalg.pinv(p_hat, hermitian=True) @ step @ cov["P_filt"][t]).T
        a[t] = means["a_filt"][t] + (a[t + 1] - means["a_filt"][t] @ step.T - system["c"]) @ gain.T
        p[t] = cov["P_filt"][t] + gain @ (p[t + 1] - p_hat) @ gain.T
    return a, p


def _lower(block):
    """Lower-triangular factor of ``block @ block.T``."""
    return np.linalg.qr(block.T, mode="r").T


def _root_covariances(system, seen, rows=None):
    """As ``_covariances``, carrying a triangular root of the covariance: it cannot lose its sign to rounding."""
    step, h, n = system["T"], system["H"], len(seen)
    m = len(step)
    root, q_root, jitter = np.sqrt(system["P0"]), np.sqrt(system["Q"]), np.sqrt(JITTER) * np.eye(m)
    out = {"P_pred": np.empty((n, m, m)), "P_filt": np.empty((n, m, m)), "K": np.zeros((n, m)), "F": np.empty(n)}
    for t in range(n):
        z = system["Z"] if rows is None else rows[t]
        out["P_pred"][t] = root @ root.T
        seen_by = z @ root
        f = out["F"][t] = seen_by @ seen_by + h + JITTER
        if seen[t]:
            k = out["K"][t] = root @ seen_by / f
            root = _lower(np.hstack([root - np.outer(k, seen_by), np.sqrt(h) * k[:, None]]))
        root = _lower(np.hstack([root, jitter]))
        out["P_filt"][t] = root @ root.T
        root = _lower(np.hstack([step @ root, q_root]))
    out["P_next"] = root @ root.T
    return out


def _steady_covariances(text, seen):
    """One gain for all dates: the fixed point of the covariance recursion, rows without a value keep their prediction."""
    system, (cov, gain, f) = build(text), _fixed_point(text)
    n, m = len(seen), len(cov)
    filtered = cov - np.outer(gain, gain) * f
    at = lambda p: np.broadcast_to(p, (n, m, m))
    return {"P_pred": at(cov), "P_filt": np.where(seen[:, None, None], filtered, cov), "F": np.full(n, f),
            "K": np.where(seen[:, None], gain, 0.0), "P_next": system["T"] @ filtered @ system["T"].T + system["Q"]}


METHODS = ("single", "standard", "cholesky", "steady_state")


CACHE_BYTES = 64 << 20
_passes: dict[tuple, dict] = {}     # a worker's latest passes, oldest first


def _shared_pass(text, n, mask, method="standard"):
    """Gains and covariances of a pattern.

    A worker keeps the latest passes by their bytes: a pass of a yearly season
    over six years holds 14 MB, so a number of passes would bound nothing.
    """
    key = (text, n, mask, method)
    found = _passes.pop(key, None)
    if found is None:
        seen = np.frombuffer(mask, bool, n)
        if method == "steady_state":
            found = _steady_covariances(text, seen)
        else:
            found = (_root_covariances if method == "cholesky" else _covariances)(build(text), seen)
    _passes[key] = found
    while len(_passes) > 1 and sum(np.asarray(v).nbytes for kept in _passes.values() for v in kept.values()) > CACHE_BYTES:
        _passes.pop(next(iter(_passes)))
    return found


@functools.lru_cache(maxsize=256)
def _shared_gains(text, n, mask):
    """Gains and variances alone, all that a likelihood needs: no covariance is kept."""
    cov = _covariances(build(text), np.frombuffer(mask, bool, n))
    return {"K": cov["K"], "F": cov["F"]}


def run_patterns(text, series, exog=None, method="standard"):
    """Yield ``(rows, system, covariances, means, observation rows)`` per pattern.

    The series of a pattern come in parts whose covariances, which are repeated
    for every series, stay below ``PART_BYTES``; a batch of any size needs no more.
    """
    system = build(text)
    if system["exog"] is not None:
        if method == "steady_state":
            raise ValueError("regressors leave no constant gain")
        for i, y in enumerate(series):
            rows = np.tile(system["Z"], (len(y), 1))
            rows[:, system["exog"]] = exog[i]
            cov = (_root_covariances if method == "cholesky" else _covariances)(system, ~np.isnan(y), rows)
            yield [i], system, cov, _means(system, cov, y[None, :], rows), rows
        return
    groups: dict = {}
    for i, y in enumerate(series):
        groups.setdefault((len(y), (~np.isnan(y)).tobytes()), []).append(i)
    for (n, mask), members in groups.items():
        cov = _shared_pass(text, n, mask, method)
        part = max(1, PART_BYTES // max(1, 8 * n * len(system["T"]) ** 2))
        for at in range(0, len(members), part):
            some = members[at:at + part]
            yield some, system, cov, _means(system, cov, np.stack([series[i] for i in some])), None


def _values(column) -> list[np.ndarray]:
    return [np.array([np.nan if v is None else v for v in values], float) for values in column]


# --- operators on panels -------------------------------------------------------------

STATES = ("series_id string, kind string, ds array<date>, state array<array<double>>, "
          "cov array<array<double>>, obs_mean array<double>, obs_var array<double>, loglik array<double>")


def kf_states(arrays: DataFrame, components: list[dict], value: str = "z",
              kinds: tuple[str, ...] = ("filtered", "predicted"), exog: str | None = None,
              method: str = "standard") -> DataFrame:
    """Latent and observed distributions, one row per series, date and kind.

    ``cov`` is the state covariance, row-major.  ``kinds`` may include
    ``smoothed``.
    """
    text = json.dumps(components)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = None if exog is None else [np.vstack(list(v)) for v in batch[exog]]
            for members, system, cov, means, rows in run_patterns(text, _values(batch[value]), x, method):
                found = {"filtered": (means["a_filt"], cov["P_filt"]), "predicted": (means["a_pred"], cov["P_pred"])}
                if "smoothed" in kinds:
                    found["smoothed"] = _smooth(system, cov, means)
                z = np.tile(system["Z"], (len(cov["F"]), 1)) if rows is None else rows
                for kind in kinds:
                    a, p = found[kind]
                    flat = list(p.reshape(len(p), -1))
                    spread = np.einsum("ti,tij,tj->t", z, p, z) + system["H"]
                    yield pd.DataFrame({
                        "series_id": batch["series_id"].iloc[members].values, "kind": kind,
                        "ds": batch["ds"].iloc[members].values,
                        "state": [list(a[:, j]) for j in range(len(members))], "cov": [flat] * len(members),
                        "obs_mean": [np.einsum("ti,ti->t", a[:, j], z) + system["d"] for j in range(len(members))],
                        "obs_var": [spread] * len(members),
                        "loglik": [means["loglik"][j] for j in range(len(members))]})

    out = arrays.select("series_id", "ds", value, *([exog] if exog else [])).mapInPandas(run, STATES)
    zipped = F.explode(F.arrays_zip("ds", "state", "cov", "obs_mean", "obs_var", "loglik")).alias("r")
    return out.select("series_id", "kind", zipped).select("series_id", "kind", "r.*")


def kf_filter(arrays: DataFrame, components: list[dict], method: str = "single", value: str = "z",
              exog: str | None = None) -> DataFrame:
    """Filtered rows of one observed column; several go through ``kf_columns``.

    ``single`` and ``standard`` carry the covariance (one observed column needs
    no matrix inverse), ``cholesky`` its triangular root, ``steady_state`` uses
    the one gain the recursion tends to from the first date on.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}")
    return kf_states(arrays, components, value, ("filtered",), exog, method).drop("kind")


def _column_step(a, p, y, z, h, method):
    """Update with several observed columns; returns state, covariance, loglik."""
    ok = ~np.isnan(y)
    if method == "single" and len(y) > 1:
        raise ValueError("the scalar method takes one observed column")
    if method == "sequential":
        loglik = 0.0
        for i in np.flatnonzero(ok):
            f = z[i] @ p @ z[i] + h[i]
            if f <= 0:
                continue
            k = p @ z[i] / f
            v = y[i] - z[i] @ a
            a, p = a + k * v, p - np.outer(k, k) * f
            loglik -= 0.5 * (np.log(2 * np.pi) + np.log(f) + v * v / f)
        return a, p, loglik
    zs, hs = z[ok], np.diag(h[ok])
    if not len(zs):
        return a, p, 0.0
    v, f = y[ok] - zs @ a, zs @ p @ zs.T + hs
    if method == "cholesky":
        low = np.linalg.cholesky(f)
        white = np.linalg.solve(low, np.column_stack([zs @ p, v]))
        k, logdet, fit = np.linalg.solve(low.T, white[:, :-1]).T, 2 * np.log(np.diag(low)).sum(), white[:, -1] @ white[:, -1]
    else:
        inverse = np.linalg.solve(f, np.eye(len(f)))
        k, logdet, fit = p @ zs.T @ inverse, np.linalg.slogdet(f)[1], v @ inverse @ v
    keep = np.eye(len(p)) - k @ zs
    return a + k @ v, keep @ p @ keep.T + k @ hs @ k.T, -0.5 * (len(v) * np.log(2 * np.pi) + logdet + fit)


def kf_columns(arrays: DataFrame, columns: list[str], components: list[dict], h: list[float],
               method: str = "sequential") -> DataFrame:
    """Filter with several observed columns per date, all seeing the same state.

    ``sequential`` takes the columns one at a time; ``standard`` and
    ``cholesky`` take them together.  All agree for independent noise.
    """
    text, variances = json.dumps(components), np.asarray(h, float)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system = build(text)
        z = np.tile(system["Z"], (len(columns), 1))
        for batch in batches:
            for i in range(len(batch)):
                y = np.column_stack([_values([batch[c].iloc[i]])[0] for c in columns])
                a, p = np.zeros(len(system["T"])), system["P0"].copy()
                states, liks = [], []
                for row in y:
                    a, p, loglik = _column_step(a, p, row, z, variances, method)
                    p = (p + p.T) / 2 + JITTER * np.eye(len(p))
                    states.append(a)
                    liks.append(loglik)
                    a, p = system["T"] @ a, system["T"] @ p @ system["T"].T + system["Q"]
                yield pd.DataFrame({"series_id": [batch["series_id"].iloc[i]], "ds": [batch["ds"].iloc[i]],
                                    "state": [states], "loglik": [liks]})

    out = arrays.select("series_id", "ds", *columns).mapInPandas(
        run, "series_id string, ds array<date>, state array<array<double>>, loglik array<double>")
    return (out.select("series_id", F.explode(F.arrays_zip("ds", "state", "loglik")).alias("r"))
            .select("series_id", "r.*"))


@functools.lru_cache(maxsize=64)
def _fixed_point(text, tolerance=1e-13, rounds=100_000):
    """Predicted covariance, gain and innovation variance the recursion tends to."""
    system = build(text)
    cov, z = system["P0"], system["Z"]
    for _ in range(rounds):
        pz = cov @ z
        f = z @ pz + system["H"]
        new = system["T"] @ (cov - np.outer(pz, pz) / f) @ system["T"].T + system["Q"]
        if np.abs(new - cov).max() < tolerance:
            return cov, pz / f, f
        cov = new
    raise ValueError("the Riccati recursion has no fixed point for these components")


def steady_gain(components: list[dict]) -> np.ndarray:
    """Constant gain: the Riccati recursion run to its fixed point."""
    return _fixed_point(json.dumps(components))[1]


def decompose(arrays: DataFrame, components: list[dict], value: str = "z", exog: str | None = None) -> DataFrame:
    """Smoothed components: ``series_id, ds, component, mean, var``.

    The noise component is what the others (and an intercept of the
    observations) leave, so all components add up to the series.
    """
    text = json.dumps(components)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            series = _values(batch[value])
            x = None if exog is None else [np.vstack(list(v)) for v in batch[exog]]
            for members, system, cov, means, rows in run_patterns(text, series, x):
                a, p = _smooth(system, cov, means)
                z = np.tile(system["Z"], (len(cov["F"]), 1)) if rows is None else rows
                total, made = np.zeros((len(members), len(cov["F"]))), []
                for name, here in system["slices"].items():
                    mean = np.einsum("tbi,ti->bt", a[:, :, here], z[:, here])
                    var = np.einsum("ti,tij,tj->t", z[:, here], p[:, here, here], z[:, here])
                    made.append((name, mean, var))
                    total += mean
                rest = np.stack([series[i] for i in members]) - total - system["d"]
                made.append(("noise", rest, np.full(len(cov["F"]), system["H"])))
                for name, mean, var in made:
                    yield pd.DataFrame({
                        "series_id": batch["series_id"].iloc[members].values, "component": name,
                        "ds": batch["ds"].iloc[members].values, "mean": list(mean), "var": [var] * len(members)})

    out = arrays.select("series_id", "ds", value, *([exog] if exog else [])).mapInPandas(
        run, "series_id string, component string, ds array<date>, mean array<double>, var array<double>")
    return (out.select("series_id", "component", F.explode(F.arrays_zip("ds", "mean", "var")).alias("r"))
            .select("series_id", "component", "r.*"))


def ss_forecast(arrays: DataFrame, components: list[dict], steps: int, freq: str = "W-MON",
                value: str = "z", start: str = "filtered", alpha: float = 0.05) -> DataFrame:
    """Mean and variance of the next ``steps`` observations in closed form.

    ``start`` picks the state after the last date; there the filtered and
    smoothed states are the same, the predicted one ignores the last value.
    """
    text = json.dumps(components)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for members, system, cov, means, _ in run_patterns(text, _values(batch[value])):
                a, p = (means["a_pred"][-1], cov["P_pred"][-1]) if start == "predicted" else (
                    means["a_filt"][-1], cov["P_filt"][-1])
                mean, var = np.empty((len(members), steps)), np.empty(steps)
                for h in range(steps):
                    a, p = a @ system["T"].T + system["c"], system["T"] @ p @ system["T"].T + system["Q"]
                    mean[:, h], var[h] = a @ system["Z"] + system["d"], system["Z"] @ p @ system["Z"] + system["H"]
                yield pd.DataFrame({"series_id": batch["series_id"].iloc[members].values,
                                    "future": batch["future"].iloc[members].values,
                                    "mean": list(mean), "var": [var] * len(members)})

    needed = arrays.select("series_id", value, future_array(F.element_at("ds", -1), steps, freq).alias("future"))
    out = needed.mapInPandas(run, "series_id string, future array<date>, mean array<double>, var array<double>")
    rows = out.select("series_id", F.posexplode(F.arrays_zip("future", "mean", "var")).alias("p", "r"))
    reach = normal_quantile(alpha) * F.sqrt("r.var")
    return rows.select("series_id", (F.col("p") + 1).alias("step"), F.col("r.future").alias("ds"),
                       F.col("r.mean").alias("mean"), F.col("r.var").alias("var"),
                       (F.col("r.mean") - reach).alias("lower"), (F.col("r.mean") + reach).alias("upper"))


def ss_irf(rows: DataFrame, components, steps: int = 40, shock_size: float | None = 1.0,
           orthogonal: bool = False, trajectory: list[list[float]] | None = None) -> DataFrame:
    """Impulse responses ``series_id, shock, step, state, value``.

    ``components(row)`` gives the component list of a row, so that fitted
    parameters can differ by series.  The shock is of ``shock_size``, or one
    standard deviation of each disturbance when that is None (the Cholesky
    factor of the covariance when ``orthogonal``); a ``trajectory`` of shocks
    sets its own number of steps.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                system = build(json.dumps(components(row)))
                m, step = len(system["T"]), system["T"]
                if trajectory is not None:
                    shocks = {0: np.asarray(trajectory, float)}
                else:
                    size = (np.linalg.cholesky(system["Q"] + 1e-300 * np.eye(m)) if orthogonal
                            else np.sqrt(system["Q"])) if shock_size is None else shock_size * (system["Q"] > 0)
                    shocks = {j: np.vstack([size[:, j], np.zeros((steps - 1, m))])
                              for j in range(m) if system["Q"][j, j] > 0}
                for j, path in shocks.items():
                    state, values = np.zeros(m), []
                    for shock in path:
                        state = step @ state + shock
                        values.append(state)
                    values = np.array(values)
                    k = np.arange(len(values))
                    yield pd.DataFrame({"series_id": row["series_id"], "shock": j, "step": np.repeat(k, m),
                                        "state": np.tile(np.arange(m), len(values)), "value": values.ravel()})

    return rows.mapInPandas(run, "series_id string, shock int, step int, state int, value double")


def ss_extract_components(states: DataFrame, layout: dict[str, tuple[int, list[float]]],
                          split_states: bool = False) -> DataFrame:
    """Named components of state rows: ``series_id, ds, component, value``.

    ``layout`` maps a name to its first state (from 0) and observation weights.
    ``split_states`` gives one row per state instead of their weighted sum.
    """
    parts = []
    for name, (first, weights) in layout.items():
        piece = F.slice("state", first + 1, len(weights))
        if split_states:
            parts += [F.struct(F.lit(f"{name}[{i}]").alias("component"), piece[i].alias("value"))
                      for i in range(len(weights))]
        else:
            weighted = F.zip_with(piece, F.array(*[F.lit(float(w)) for w in weights]), lambda s, w: s * w)
            parts.append(F.struct(F.lit(name).alias("component"),
                                  F.aggregate(weighted, F.lit(0.0), lambda a, v: a + v).alias("value")))
    return (states.select("series_id", "ds", F.explode(F.array(*parts)).alias("c"))
            .select("series_id", "ds", "c.component", "c.value"))


def periodogram(arrays: DataFrame, value: str = "z", shortest: float = 3.0, longest: float | None = None,
                finer: int = 1) -> DataFrame:
    """Power of the straight-line residual by frequency: ``series_id, wave, length, power``.

    ``wave`` counts cycles over the series, in steps of 1 / ``finer`` from 1 (or
    as many as make ``longest``) up to cycles of ``shortest`` steps.  Missing
    values take no part.  Each power is two trigonometric sums over the series'
    own array, so nothing is shuffled; series with fewer than three values, or
    too short for one cycle, give no rows.
    """
    seen = F.filter(F.transform(value, lambda v, i: F.struct(i.cast("double").alias("t"), v.alias("v"))),
                    lambda p: p["v"].isNotNull() & ~F.isnan(p["v"]))
    total = lambda of: F.aggregate("seen", F.lit(0.0), lambda acc, p: acc + of(p))
    rows = arrays.select("series_id", F.size(value).alias("n"), seen.alias("seen")).where(F.size("seen") > 2)
    rows = rows.withColumns({"count": F.size("seen"), "mt": total(lambda p: p["t"]) / F.size("seen"),
                             "mv": total(lambda p: p["v"]) / F.size("seen")})
    rows = rows.withColumn("slope", total(lambda p: (p["t"] - F.col("mt")) * p["v"])
                           / total(lambda p: (p["t"] - F.col("mt")) * (p["t"] - F.col("mt"))))
    rest = F.transform("seen", lambda p: F.struct(
        p["t"].alias("t"), (p["v"] - F.col("mv") - F.col("slope") * (p["t"] - F.col("mt"))).alias("v")))
    low = F.lit(finer) if longest is None else F.greatest(F.ceil(F.col("n") * finer / longest), F.lit(1))
    high = F.floor(F.col("n") * finer / shortest)
    rows = (rows.withColumn("rest", rest).where(high >= low)
            .select("series_id", "n", "count", "rest", F.explode(F.sequence(low.cast("long"), high.cast("long"))).alias("k")))
    angle = lambda p: p["t"] * (F.col("k") / finer) * (2 * np.pi) / F.col("n")
    sums = lambda fn: F.aggregate("rest", F.lit(0.0), lambda acc, p: acc + p["v"] * fn(angle(p)))
    return rows.withColumns({"c": sums(F.cos), "s": sums(F.sin)}).select(
        "series_id", (F.col("k") / finer).alias("wave"), (F.col("n") * finer / F.col("k")).alias("length"),
        ((F.col("c") * F.col("c") + F.col("s") * F.col("s")) / F.col("count")).alias("power"))


CYCLE_DAMPING = ("0.9", "0.97", "1.0")


def cycle_candidates(arrays: DataFrame, peaks: int = 3, finer: int = 4, **bounds) -> DataFrame:
    """Candidate rows: the lengths of the highest local peaks of the series' periodogram, with each damping."""
    along = Window.partitionBy("series_id").orderBy("wave")
    power = periodogram(arrays, finer=finer, **bounds).withColumns({
        "before": F.coalesce(F.lag("power").over(along), F.lit(-1.0)), "after": F.coalesce(F.lead("power").over(along), F.lit(-1.0))})
    tops = (power.where("power >= before AND power > after").groupBy("series_id")
            .agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("power")).alias("p"), "length"))), 1, peaks).alias("tops")))
    pairs = F.flatten(F.transform("tops", lambda top: F.transform(
        F.array(*map(F.lit, CYCLE_DAMPING)), lambda d: F.create_map(F.lit("length"), top["length"].cast("string"), F.lit("damping"), d))))
    rows = arrays.join(tops, "series_id").select(*arrays.columns, F.lit("cycle").alias("model"), F.posexplode(pairs))
    return rows.withColumnsRenamed({"pos": "candidate_id", "col": "params"})


def best_cycle(arrays: DataFrame, grid: dict[str, list[str]] | None = None) -> DataFrame:
    """Cycle length and damping by likelihood per series, then its smoother.

    Lengths come from the peaks of each series' own periodogram, unless a
    ``grid`` of lengths and dampings is given.  Columns as in ``decompose`` plus
    the chosen ``length`` and ``damping``.  A series without a peak gives no rows.
    """
    parts = lambda p: [level_trend(1, 0.1), cycle(float(p["length"]), float(p["damping"]), 0.05), noise(0.5)]

    def fit(z, params):
        ((_, _, _, means, _),) = run_patterns(json.dumps(parts(params)), [z])
        return np.array([]), -means["loglik"].sum(), "ok"

    rows = explode_grid(arrays, "cycle", grid) if grid else cycle_candidates(arrays)
    best = pick_best_candidate(fit_candidates(rows, fit)).select("series_id", "params")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i, z in enumerate(_values(batch["z"])):
                ((_, system, cov, means, _),) = run_patterns(json.dumps(parts(dict(batch["params"].iloc[i]))), [z])
                a, p = _smooth(system, cov, means)
                here = system["slices"]["cycle"].start
                yield pd.DataFrame({"series_id": [batch["series_id"].iloc[i]], "params": [batch["params"].iloc[i]],
                                    "ds": [batch["ds"].iloc[i]], "mean": [a[:, 0, here]], "var": [p[:, here, here]]})

    out = best.join(arrays.select("series_id", "ds", "z"), "series_id").mapInPandas(
        run, "series_id string, params map<string,string>, ds array<date>, mean array<double>, var array<double>")
    return (out.select("series_id", F.element_at("params", "length").cast("double").alias("length"),
                       F.element_at("params", "damping").cast("double").alias("damping"),
                       F.explode(F.arrays_zip("ds", "mean", "var")).alias("r"))
            .select("series_id", "length", "damping", "r.*"))


# --- closed forms without noise --------------------------------------------------------

def trend_regression(panel: DataFrame, value: str = "z") -> DataFrame:
    """A level and slope without disturbances: a straight line per series."""
    rows = panel.withColumn("t", (F.row_number().over(by_date()) - 1).cast("double"))
    fit = rows.groupBy("series_id").agg(F.regr_slope(value, "t").alias("slope"),
                                        F.regr_intercept(value, "t").alias("level"))
    return rows.join(fit, "series_id").withColumn("mean", F.col("level") + F.col("slope") * F.col("t"))


def season_means(panel: DataFrame, season: int, value: str = "z") -> DataFrame:
    """Dummy season without disturbances: mean per season index, centred."""
    rows = panel.withColumn("season_index", F.pmod(F.row_number().over(by_date()) - 1, F.lit(season)))
    means = rows.groupBy("series_id", "season_index").agg(F.avg(value).alias("mean"))
    center = means.groupBy("series_id").agg(F.avg("mean").alias("center"))
    return means.join(center, "series_id").select(
        "series_id", "season_index", (F.col("mean") - F.col("center")).alias("effect"))


def fourier_columns(t: Column, season: float, n: int) -> dict[str, Column]:
    angle = lambda j: t * (2 * np.pi * j / season)
    return {f"{f}_{j}": (F.cos if f == "cos" else F.sin)(angle(j)) for j in range(1, n + 1) for f in ("cos", "sin")}


def regress(panel: DataFrame, columns: list[str], value: str = "z") -> DataFrame:
    """Least squares of ``value`` on constant columns per series.

    The cross products are one grouped aggregation; each series then costs one
    small solve.  ``coef`` lists the intercept, then the columns in order.
    """
    names = ["_one", *columns]
    term = lambda c: F.lit(1.0) if c == "_one" else F.col(c).cast("double")
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = panel.groupBy("series_id").agg(
        F.array(*[F.sum(term(names[i]) * term(names[j])) for i, j in pairs]).alias("xx"),
        F.array(*[F.sum(term(c) * F.col(value)) for c in names]).alias("xy"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            gram = np.zeros((len(batch), len(names), len(names)))
            for position, (i, j) in enumerate(pairs):
                gram[:, i, j] = gram[:, j, i] = batch["xx"].str[position]
            coef = [np.linalg.lstsq(g, np.asarray(b, float), rcond=None)[0] for g, b in zip(gram, batch["xy"])]
            yield pd.DataFrame({"series_id": batch["series_id"], "coef": coef})

    return sums.mapInPandas(run, "series_id string, coef array<double>")


# --- structural forecaster -------------------------------------------------------------

SIGMA_GRID = {"sigma_level": ["0.003", "0.01", "0.03", "0.1", "0.3"],
              "sigma_season": ["0.0003", "0.001", "0.003", "0.01", "0.03"]}
PRIOR_SIGMA = 0.01


def structural(params: dict, season: int = 52) -> list[dict]:
    """Random-walk level plus trigonometric season, no measurement noise.

    The level's start has variance 1; the season's coefficients follow their
    own narrow prior.
    """
    fourier = season_fourier(season, season // 2, float(params["sigma_season"]))
    return [level_trend(1, float(params["sigma_level"])), {**fourier, "p0": PRIOR_SIGMA}]


def fit_structural(z, params, season=52):
    """Log posterior (negated) of one pair of scales on one series."""
    text = json.dumps(structural(params, season))
    means = _means(build(text), _shared_gains(text, len(z), (~np.isnan(z)).tobytes()), z[None, :])
    prior = sum(-0.5 * (float(params[k]) / PRIOR_SIGMA) ** 2 for k in SIGMA_GRID)
    posterior = means["loglik"].sum() + prior
    return np.array([float(params[k]) for k in SIGMA_GRID]), -posterior, "ok"


def apply_structural(z, ds, params, coef, future, season=52):
    """One-step predictions, forecasts and standard errors."""
    del ds, coef
    text = json.dumps(structural(params, season))
    ((_, system, cov, means, _),) = run_patterns(text, [z])
    a, p, mean, var = means["a_filt"][-1, 0], cov["P_filt"][-1], [], []
    for _ in future:
        a, p = system["T"] @ a, system["T"] @ p @ system["T"].T + system["Q"]
        mean.append(system["Z"] @ a)
        var.append(system["Z"] @ p @ system["Z"])
    return means["a_pred"][:, 0] @ system["Z"], np.array(mean), np.sqrt(var)
