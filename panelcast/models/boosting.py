"""Boosting searched on a table of few rows: a training is a row of one job.

Spark ML starts a job for every level of every tree, whose cost in the driver
does not depend on the rows.  A panel by calendar week has some thousand rows at
any size of the facts, so its trainings (a setting and a fold each) are spread
over tasks instead, one block of at most ``MOST_ROWS`` rows each.

Trees are those of ``GBTRegressor`` on one partition: the same thresholds, rows
(``rand`` is what it draws them by) and features per node, hence the same errors.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from panelcast.session import spread

# Spark ML finds thresholds from all rows up to here, from a sample beyond.
MOST_ROWS = 10_000
ERRORS = "setting int, held int, errors array<double>"


def thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """Ascending split points of one feature: at most ``bins`` - 1, of nearly equal counts."""
    distinct, counts = np.unique(values, return_counts=True)
    middle = (distinct[:-1] + distinct[1:]) / 2
    most = min(bins, len(values)) - 1
    if len(middle) <= most:
        return middle
    stride = len(values) / (most + 1)
    seen, target, out = np.cumsum(counts), stride, []
    for i in range(len(middle)):
        if abs(seen[i] - target) < abs(seen[i + 1] - target):
            out.append(middle[i])
            target += stride
    return np.array(out)


def _longs(seeds: np.ndarray, count: int) -> np.ndarray:
    """The first ``count`` numbers of ``java.util.Random.nextLong`` from each seed."""
    mask, state, halves = np.uint64(2**48 - 1), (seeds ^ np.uint64(0x5DEECE66D)) & np.uint64(2**48 - 1), []
    for _ in range(2 * count):
        state = (state * np.uint64(0x5DEECE66D) + np.uint64(11)) & mask
        halves.append((state >> np.uint64(16)).astype(np.uint32).view(np.int32).astype(np.int64))
    return np.column_stack([(high << 32) + low for high, low in zip(halves[::2], halves[1::2])])


def _murmur(words: tuple[np.ndarray, ...], start) -> np.ndarray:
    """32-bit MurmurHash3 of little-endian words."""
    turned = lambda x, by: x << np.uint32(by) | x >> np.uint32(32 - by)
    h = start
    for word in words:
        h = turned(h ^ turned(word * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593), 13) * np.uint32(5) + np.uint32(0xE6546B64)
    h = h ^ np.uint32(4 * len(words))
    h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return h ^ h >> np.uint32(16)


def _uniforms(seeds: np.ndarray, count: int) -> np.ndarray:
    """What ``rand`` gives in the first ``count`` rows of the first partition, for each seed."""
    words = seeds.astype(">i8").view("<u4").astype(np.uint32).reshape(-1, 2).T
    low = _murmur(words, np.full(len(seeds), 0x3C074A61, np.uint32))
    state, parts = _murmur(words, low).astype(np.uint64) << np.uint64(32) | low, []
    for bits in (26, 27) * count:
        state = state ^ state << np.uint64(21)
        state = state ^ state >> np.uint64(35)
        state = state ^ state << np.uint64(4)
        parts.append((state & np.uint64(2**bits - 1)).astype(np.int64))
    return np.column_stack([((high << 27) + low) * 2.0**-53 for high, low in zip(parts[::2], parts[1::2])])


def node_features(count: int, share: float, trees: int, nodes: int, seed: int) -> np.ndarray:
    """Features each node of each tree may split on, by its place in the order of nodes: ``[tree, node, feature]``."""
    kept = math.ceil(share * count)
    out = np.tile(np.arange(kept, dtype=np.int16), (trees * nodes, 1))
    if kept < count:
        seeds = _longs(np.array([seed + tree for tree in range(trees)], np.int64).view(np.uint64), nodes)
        draws = _uniforms(seeds.ravel(), count - kept)
        for item in range(kept, count):
            place = (draws[:, item - kept] * (item + 1)).astype(int)
            hit = np.flatnonzero(place < kept)
            out[hit, place[hit]] = item
    return out.reshape(trees, nodes, kept)


def _variance(count, total, squares):
    return (squares - total * total / count) / count


def grown_tree(bins: np.ndarray, splits: np.ndarray, target: np.ndarray, drawn: np.ndarray, depth: int, least: int,
               allowed: np.ndarray) -> np.ndarray:
    """Predictions of all rows by one regression tree grown level by level on the ``drawn`` ones.

    ``bins`` has the bin of each row and feature, ``splits`` the number of thresholds of each feature.
    """
    count, features = bins.shape
    width = max(2, 1 + splits.max())
    at, out = np.zeros(count, int), np.empty(count)   # node of a row among the level's nodes, -1 in a leaf
    nodes, asked = [None], 0                          # count, sum and sum of squares of each node
    for level in range(depth):
        inside = np.flatnonzero(drawn & (at >= 0))
        cells = ((at[inside, None] * features + np.arange(features)) * width + bins[inside]).ravel()
        values = np.repeat(target[inside], features)
        shape = (len(nodes), features, width)
        sums = np.stack([np.bincount(cells, w, minlength=math.prod(shape)).reshape(shape).cumsum(axis=2)
                         for w in (None, values, values * values)]).astype(float)
        left = sums[..., :-1]
        right = sums[..., -1:] - left
        chosen = allowed[asked:asked + len(nodes)]
        asked += len(nodes)
        if nodes[0] is None:
            first = next((f for f in chosen[0] if splits[f]), chosen[0][0])
            nodes = [tuple(left[:, 0, first, 0] + right[:, 0, first, 0])]
        own = np.array([_variance(*node) for node in nodes])[:, None, None]
        with np.errstate(all="ignore"):
            before, after, held = _variance(*left), _variance(*right), left[0] + right[0]
            gain = own - left[0] / held * before - right[0] / held * after
        gain = np.where((left[0] >= least) & (right[0] >= least) & (gain >= 0), gain, -np.inf)
        split = np.zeros((len(nodes), 2), int)
        child, value, pushed = np.full((len(nodes), 2), -1), np.empty((len(nodes), 2)), []
        for i, node in enumerate(nodes):
            ranked = gain[i, chosen[i]].ravel()
            best = int(ranked.argmax())
            if not ranked[best] > 0:
                value[i] = node[1] / node[0]
                continue
            feature, point = chosen[i][best // (width - 1)], best % (width - 1)
            split[i] = feature, point
            for side, (part, variance) in enumerate(((left, before), (right, after))):
                node = tuple(part[:, i, feature, point])
                value[i, side] = node[1] / node[0]
                if level + 1 < depth and abs(variance[i, feature, point]) >= np.finfo(float).eps:
                    pushed.append((i, side, node))
        nodes = []
        for i, side, node in reversed(pushed):        # the last one pushed is the next one split
            child[i, side] = len(nodes)
            nodes.append(node)
        moved = np.flatnonzero(at >= 0)
        here = at[moved]
        side = (bins[moved, split[here, 0]] > split[here, 1]).astype(int)
        out[moved], at[moved] = value[here, side], child[here, side]
        if not nodes:
            break
    return out


def errors_after_trees(x: np.ndarray, z: np.ndarray, train: np.ndarray, drawn: np.ndarray, setting: dict, trees: int,
                       allowed: np.ndarray, max_bins: int) -> list[float]:
    """Mean squared error of the rows outside ``train`` after each tree."""
    points = [thresholds(column, max_bins) for column in x[train].T]
    bins = np.column_stack([np.searchsorted(p, column) for p, column in zip(points, x.T)])
    splits = np.array([len(p) for p in points])
    made, errors = np.zeros(len(z)), []
    for tree in range(trees):
        target = z if tree == 0 else 2 * (z - made)
        grown = grown_tree(bins, splits, target, drawn[:, tree], setting["maxDepth"], setting["minInstancesPerNode"], allowed[tree])
        made = made + grown * (1.0 if tree == 0 else setting["stepSize"])
        errors.append(float(np.mean((z - made)[~train] ** 2)))
    return errors


def boosting_errors(features: DataFrame, settings: list[tuple[dict, int]], folds: int, seed: int, rows: int,
                    max_bins: int) -> dict[tuple[int, int], list[float]]:
    """Errors after each tree by number of the setting (``settings`` has it with its trees) and held-out fold.

    ``features`` has one partition of ``rows`` rows, at most ``MOST_ROWS``.
    """
    count = len(features.first()["features"])
    numbered = features.select("z", "fold", vector_to_array("features").alias("x"), F.monotonically_increasing_id().alias("place"))
    most = max(trees for _, trees in settings)
    parts, allowed = [], {}
    for rate, share in sorted({(s["subsamplingRate"], s["featureSubsetStrategy"]) for s, _ in settings}):
        alike = [i for i, (s, _) in enumerate(settings) if (s["subsamplingRate"], s["featureSubsetStrategy"]) == (rate, share)]
        nodes = max(min(2 ** s["maxDepth"] - 1, 2 * (rows // s["minInstancesPerNode"]) + 1) for s, _ in (settings[i] for i in alike))
        allowed[share] = node_features(count, float(share), most, max(1, nodes), seed)
        draws = F.array(*[F.rand(seed + tree + 1) < rate if rate < 1 else F.lit(True) for tree in range(most)])
        for fold in range(folds):
            kept = numbered.where(F.col("fold") != fold).withColumn("drawn", draws)
            held = numbered.where(F.col("fold") == fold).withColumn("drawn", F.array_repeat(F.lit(False), most))
            parts += [p.select(F.explode(F.array(*map(F.lit, alike))).alias("setting"), F.lit(fold).alias("held"), "*") for p in (kept, held)]
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)

    def train(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        (number, fold), block = key, block.sort_values("place")
        setting, trees = settings[number]
        errors = errors_after_trees(np.stack(block["x"]), block["z"].to_numpy(float), block["fold"].to_numpy() != fold,
                                    np.stack(block["drawn"]).astype(bool), setting, trees,
                                    allowed[setting["featureSubsetStrategy"]], max_bins)
        return pd.DataFrame({"setting": [number], "held": [fold], "errors": [errors]})

    # One row per training.
    done = spread(every, "setting", "held").groupBy("setting", "held").applyInPandas(train, ERRORS).collect()
    return {(r["setting"], r["held"]): r["errors"] for r in done}
