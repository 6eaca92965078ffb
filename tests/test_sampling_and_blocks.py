"""Draws without replacement, and fold scores by subtraction of sums."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import seasonal
from panelcast.models import arima, autoregression
from panelcast.operators import search


@pytest.mark.parametrize("sizes, n", [((4, 6), 24), ((4, 6), 5), ((7,), 7), ((1,), 3), ((144, 144), 20_736), ((3, 3, 3, 2, 2), 50)])
def test_draws_never_repeat(spark, sizes, n):
    grid = {f"p{i}": [str(v) for v in range(size)] for i, size in enumerate(sizes)}
    series = spark.createDataFrame([("a",), ("b",), ("a",)], "series_id string")
    rows = series.select(search.sampled_numbers("m", grid, n, 3).alias("c")).collect()
    total = int(np.prod(sizes))
    for row in rows:
        assert len(set(row["c"])) == len(row["c"]) == min(n, total) and set(row["c"]) <= set(range(total))
    assert rows[0]["c"] == rows[2]["c"]
    if total > 20 and n < total:
        assert rows[0]["c"] != rows[1]["c"] and sorted(rows[0]["c"]) != rows[0]["c"]


def test_draws_cover_the_grid_evenly(spark):
    grid = arima.arima_grid("W-MON")
    series = spark.range(2000).select(F.col("id").cast("string").alias("series_id"))
    numbers = series.select(F.explode(search.sampled_numbers("arima", grid, 20, 1)).alias("c"))
    counts = [r[1] for r in numbers.groupBy(F.floor(F.col("c") / (20_736 // 16)).alias("part")).count().collect()]
    assert len(counts) == 16 and max(counts) < 1.15 * min(counts)


@pytest.mark.parametrize("rolling", [False, True])
def test_block_scores_equal_separate_fits(make_panel, rolling):
    values = {"a": seasonal(90, noise=0.3), "b": seasonal(71, seed=5, noise=0.4), "short": [1.0, 2.0, 4.0, 3.0]}
    panel = make_panel(values).withColumn("z", F.col("y"))
    candidates = [{"lags": "3", "trend": "ct"}, {"lags": "1", "trend": "n"}, {"lags": "2", "trend": "c"}]
    sums = autoregression.block_sums(panel, lags=3)
    got = {(r["series_id"], r["candidate_id"]): r for r in autoregression.score_blocks(sums, candidates, rolling).collect()}
    for name in ("a", "b"):
        z = np.asarray(values[name])
        rows = np.arange(3, len(z))
        block = np.concatenate([np.full(len(p), i) for i, p in enumerate(np.array_split(rows, 3))])
        for number, params in enumerate(candidates):
            columns = [np.ones(len(rows))] * ("c" in params["trend"]) + [rows + 1.0] * ("t" in params["trend"])
            x = np.column_stack(columns + [z[rows - k] for k in range(1, int(params["lags"]) + 1)])
            errors = []
            for f in range(1 if rolling else 0, 3):
                train = block < f if rolling else block != f
                coef = np.linalg.lstsq(x[train], z[rows][train], rcond=None)[0]
                errors.append(np.mean((z[rows] - x @ coef)[block == f] ** 2))
            assert got[name, number]["score"] == pytest.approx(np.mean(errors), rel=1e-6)
    assert all(not r["status"].startswith("ok") for (name, _), r in got.items() if name == "short")
