"""Bayesian level-trend-season regression from grouped sums.

``y = baseline + trend * t + season[t mod s] + noise`` with normal priors.
The sums per season index are all the data the posterior needs; they are
aggregated in Spark, and each series is then one small linear solve.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from panelcast.functions.calendar import BAYES_SEASON, BAYES_SEASON_FALLBACK, base_freq
from panelcast.operators.grid import by_date, time_index, whole

FITTED = ("series_id string, model string, params map<string,string>, coef array<double>, "
          "variance array<double>, sigma2 double, loglik double, n bigint")
# Prior scales of baseline, trend, season and noise.
PRIOR = {"baseline_sigma": 2.0, "trend_sigma": 1.0, "seasonal_sigma": 2.0, "obs_sigma": 3.0}


def season_length(freq: str) -> int:
    return BAYES_SEASON.get(base_freq(freq), BAYES_SEASON_FALLBACK)


def season_sums(train: DataFrame, season: int) -> DataFrame:
    """One row per series: sums of 1, t, t^2, z, tz, z^2 by season index."""
    rows = time_index(train.withColumn("center_z", F.median("z").over(whole())), season)
    rows = rows.withColumn("t", F.col("t").cast("double"))
    sums = rows.groupBy("series_id", "season_index").agg(
        F.count("*").cast("double").alias("n"), F.sum("t").alias("t"), F.sum(F.col("t") ** 2).alias("tt"),
        F.sum("z").alias("z"), F.sum(F.col("t") * F.col("z")).alias("tz"), F.sum(F.col("z") ** 2).alias("zz"), F.first("center_z").alias("center_z"))
    part = F.struct("season_index", "n", "t", "tt", "z", "tz", "zz")
    listed = sums.groupBy("series_id").agg(F.sort_array(F.collect_list(part)).alias("m"),
                                           F.first("center_z").alias("center_z"))
    columns = ["season_index", "n", "t", "tt", "z", "tz", "zz"]
    return listed.select("series_id", "center_z", *[F.col(f"m.{c}").alias(c) for c in columns])


def _posterior(row, season, learn_scales, rounds):
    """Posterior mean and variance; prior scales by expectation-maximisation."""
    k, at = season + 2, 2 + np.asarray(row["season_index"])
    counts, t, tt, z, tz = (np.asarray(row[c], float) for c in ("n", "t", "tt", "z", "tz"))
    gram, cross = np.zeros((k, k)), np.zeros(k)
    gram[:2, :2] = [[counts.sum(), t.sum()], [t.sum(), tt.sum()]]
    gram[at, 0] = gram[0, at] = gram[at, at] = counts
    gram[at, 1] = gram[1, at] = t
    cross[0], cross[1], cross[at] = z.sum(), tz.sum(), z
    zz, n, center = float(np.sum(row["zz"])), counts.sum(), row["center_z"]
    # Center the baseline's prior by fitting z - center.
    ones = gram[:, 0]
    zz, cross = zz - 2 * center * cross[0] + center ** 2 * n, cross - center * ones
    scale = np.r_[PRIOR["baseline_sigma"], PRIOR["trend_sigma"], np.full(season, PRIOR["seasonal_sigma"])]
    noise = max(zz / n, 1e-6)
    for _ in range(rounds):
        precision = gram / noise + np.diag(1 / scale ** 2)
        cov = np.linalg.inv(precision)
        mean = cov @ cross / noise
        rss = zz - 2 * mean @ cross + mean @ gram @ mean
        noise = max((rss + np.sum(gram * cov)) / n, 1e-9)
        if learn_scales:
            swing = np.sqrt(np.mean(mean[2:] ** 2 + np.diag(cov)[2:]))
            scale[2:] = min(max(swing, 1e-3), PRIOR["seasonal_sigma"])
    shift = mean[2:].mean()
    coef = np.r_[mean[0] + center + shift, mean[1], mean[2:] - shift]
    loglik = -0.5 * (n * np.log(2 * np.pi * noise) + rss / noise)
    return coef, np.diag(cov), noise, loglik, int(n)


def bayes_fit(train: DataFrame, freq: str = "W-MON", learn_scales: bool = True, rounds: int = 15) -> DataFrame:
    """Posterior means, variances and noise variance per series.

    ``learn_scales=False`` keeps the fixed prior scales and updates the noise
    only.  ``coef`` is baseline, trend, then the zero-sum season.
    """
    season = season_length(freq)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            solved = [_posterior(row, season, learn_scales, rounds) for _, row in batch.iterrows()]
            yield pd.DataFrame({
                "series_id": batch["series_id"], "model": "bayes",
                "params": [{"season": str(season), "learn_scales": str(learn_scales).lower()}] * len(batch),
                "coef": [s[0] for s in solved], "variance": [s[1] for s in solved],
                "sigma2": [s[2] for s in solved], "loglik": [s[3] for s in solved], "n": [s[4] for s in solved]})

    return season_sums(train, season).mapInPandas(run, FITTED)


def mean_at(coef: Column, t: Column) -> Column:
    season = F.size(coef) - 2
    return coef[0] + coef[1] * t + coef[(F.pmod(t, season) + 2).cast("int")]


def bayes_fitted(train: DataFrame, fitted: DataFrame) -> DataFrame:
    """``zhat`` for every training row."""
    rows = train.withColumn("t", F.row_number().over(by_date()) - 1)
    return (rows.join(fitted.select("series_id", "model", "coef"), "series_id")
            .withColumn("zhat", mean_at(F.col("coef"), F.col("t"))).drop("coef"))


def forecast_array(steps: int) -> Column:
    """Forecasts from the columns ``coef`` and ``n``; time goes on from ``n``."""
    return F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda h: mean_at(F.col("coef"), F.col("n") + h))
