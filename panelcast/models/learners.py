"""Support vector and small neural regressors on lag and calendar features.

Each fit sees one short series.  Features are standardised with the training
rows, so the two gamma settings of the kernel coincide.
"""

from __future__ import annotations

import zlib

import numpy as np

SVR_GRID = {"kernel": ["rbf", "linear"], "C": ["0.1", "1", "10"], "gamma": ["scale", "auto"],
            "epsilon": ["0.01", "0.1"]}
MLP_GRID = {"hidden_layer_sizes": ["10", "20", "10,5"], "activation": ["relu", "tanh"], "alpha": ["0.01", "0.1"]}
ROUNDS = 1000


def _calendar(ds):
    days = ds.astype("datetime64[D]")
    month = days.astype("datetime64[M]")
    weekday = (days.astype(int) + 3) % 7
    return np.column_stack([month.astype(int) % 12 + 1, weekday, (days - month).astype(int) + 1, weekday >= 5]).astype(float)


def feature_matrix(z, ds, lags):
    """Rows that have every lag: lags in list order, then calendar columns."""
    first = max(lags)
    columns = [z[first - k:len(z) - k] for k in lags]
    return np.column_stack([*columns, _calendar(ds[first:])]), z[first:]


def _standardise(x):
    center, spread = x.mean(axis=0), x.std(axis=0)
    return center, np.where(spread > 0, spread, 1.0)


def _kernel(a, b, params):
    if params["kernel"] == "linear":
        return a @ b.T + 1.0
    squared = (a ** 2).sum(1)[:, None] + (b ** 2).sum(1) - 2 * a @ b.T
    return np.exp(-np.maximum(squared, 0) / a.shape[1]) + 1.0


def fit_svr(x, y, params):
    """Dual weights by accelerated proximal gradient; the kernel's constant
    carries the intercept.  Every weight stays inside the box [-C, C]."""
    c, eps = float(params["C"]), float(params["epsilon"])
    kernel = _kernel(x, x, params)
    rate = 1.0 / np.linalg.eigvalsh(kernel)[-1]
    beta = ahead = np.zeros(len(y))
    inertia = 1.0
    for _ in range(ROUNDS):
        moved = ahead - rate * (kernel @ ahead - y)
        new = np.clip(np.sign(moved) * np.maximum(np.abs(moved) - rate * eps, 0), -c, c)
        grown = (1 + np.sqrt(1 + 4 * inertia ** 2)) / 2
        ahead = new + (inertia - 1) / grown * (new - beta)
        done = np.abs(new - beta).max() < 1e-6 * c
        beta, inertia = new, grown
        if done:
            break
    return beta


def _mlp_forward(x, layers, activation):
    acts = [x]
    for i, (w, b) in enumerate(layers):
        x = x @ w + b
        if i < len(layers) - 1:
            x = np.maximum(x, 0) if activation == "relu" else np.tanh(x)
        acts.append(x)
    return acts


def fit_mlp(x, y, params, seed, epochs=500, batch=32, patience=10):
    """Adam on squared error with L2, stopped on a held-out fifth."""
    rng = np.random.default_rng(seed)
    sizes = [x.shape[1], *map(int, params["hidden_layer_sizes"].split(",")), 1]
    activation, alpha = params["activation"], float(params["alpha"])
    layers = [[rng.uniform(-1, 1, (a, b)) * np.sqrt((2 if activation == "tanh" else 6) / (a + b)), np.zeros(b)]
              for a, b in zip(sizes, sizes[1:])]
    order = rng.permutation(len(y))
    held, used = order[:max(len(y) // 5, 1)], order[max(len(y) // 5, 1):]
    flat = [p for layer in layers for p in layer]
    first, second = [np.zeros_like(p) for p in flat], [np.zeros_like(p) for p in flat]
    best, kept, waited, step = np.inf, None, 0, 0
    for _ in range(epochs):
        rng.shuffle(used)
        for start in range(0, len(used), batch):
            rows = used[start:start + batch]
            acts = _mlp_forward(x[rows], layers, activation)
            grad = (acts[-1][:, 0] - y[rows])[:, None] / len(rows)
            grads = []
            for i in range(len(layers) - 1, -1, -1):
                w = layers[i][0]
                grads = [acts[i].T @ grad + alpha * w / len(rows), grad.sum(axis=0)] + grads
                if i:
                    slope = acts[i] > 0 if activation == "relu" else 1 - acts[i] ** 2
                    grad = (grad @ w.T) * slope
            step += 1
            rate = 1e-3 * np.sqrt(1 - .999 ** step) / (1 - .9 ** step)
            for p, g, m, v in zip(flat, grads, first, second):
                m += .1 * (g - m)
                v += .001 * (g * g - v)
                p -= rate * m / (np.sqrt(v) + 1e-8)
        loss = np.mean((_mlp_forward(x[held], layers, activation)[-1][:, 0] - y[held]) ** 2)
        waited = 0 if loss < best - 1e-4 else waited + 1
        if loss < best:
            best, kept = loss, [p.copy() for p in flat]
        if waited >= patience:
            break
    return np.concatenate([p.ravel() for p in kept]) if kept is not None else np.concatenate([p.ravel() for p in flat])


def _unflatten(coef, params, k):
    sizes, out, i = [k, *map(int, params["hidden_layer_sizes"].split(",")), 1], [], 0
    for a, b in zip(sizes, sizes[1:]):
        out.append((coef[i:i + a * b].reshape(a, b), coef[i + a * b:i + a * b + b]))
        i += a * b + b
    return out


def _fit(kind, x, y, params):
    """Weights preceded by the standardisation of the features."""
    center, spread = _standardise(x)
    scaled = (x - center) / spread
    if kind == "svr":
        weights = fit_svr(scaled, y, params)
    else:
        weights = fit_mlp(scaled, y, params, zlib.crc32(y.tobytes()))
    return np.r_[center, spread, weights]


def _predictor(kind, params, coef, train_x):
    k = train_x.shape[1]
    center, spread, weights = coef[:k], coef[k:2 * k], coef[2 * k:]
    if kind == "svr":
        base = (train_x - center) / spread
        keep = np.flatnonzero(weights)
        return lambda x: _kernel((x - center) / spread, base[keep], params) @ weights[keep]
    layers = _unflatten(weights, params, k)
    return lambda x: _mlp_forward((x - center) / spread, layers, params["activation"])[-1][:, 0]


def make(kind: str, lags: list[int]):
    """``(score_fold, fit, apply)`` of one family for a lag list."""
    def score_fold(z, ds, params, fold, folds):
        if len(z) < max(lags) + 10 * folds:
            return np.nan
        x, y = feature_matrix(z, ds, lags)
        parts = np.array_split(np.arange(len(y)), folds)
        rest = np.concatenate([p for i, p in enumerate(parts) if i != fold])
        coef = _fit(kind, x[rest], y[rest], params)
        return np.mean((y[parts[fold]] - _predictor(kind, params, coef, x[rest])(x[parts[fold]])) ** 2)

    def fit(z, ds, params):
        return _fit(kind, *feature_matrix(z, ds, lags), params)

    def apply(z, ds, params, coef, future):
        x, _ = feature_matrix(z, ds, lags)
        predict = _predictor(kind, params, coef, x)
        history = np.r_[z, np.zeros(len(future))]
        dates = _calendar(future)
        for h in range(len(future)):
            end = len(z) + h
            row = np.r_[[history[end - k] if end >= k else 0.0 for k in lags], dates[h]]
            history[end] = predict(row[None, :])[0]
        return predict(x), history[len(z):], None

    return score_fold, fit, apply
