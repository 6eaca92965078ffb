import numpy as np
import pandas as pd
import pytest

from panelcast.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", "tests", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_panel(spark):
    """Panel from ``{series: values}`` on weekly Mondays."""
    def make(series, start="2020-01-06", freq="W-MON"):
        parts = [pd.DataFrame({"series_id": name, "ds": pd.date_range(start, periods=len(values), freq=freq).date,
                               "y": np.asarray(values, float)}) for name, values in series.items()]
        return spark.createDataFrame(pd.concat(parts), "series_id string, ds date, y double")
    return make


@pytest.fixture(scope="session")
def make_arrays(make_panel):
    """One row per series with an identity scaler."""
    from pyspark.sql import functions as F

    from panelcast.operators.grid import as_arrays

    def make(series):
        return as_arrays(make_panel(series).withColumn("z", F.col("y")), "z").withColumns(
            {"center": F.lit(0.0), "scale": F.lit(1.0)})
    return make


def seasonal(n, s=12, slope=0.05, seed=0, noise=0.0):
    t = np.arange(n)
    swing = np.sin(2 * np.pi * np.arange(s) / s) + 0.3 * np.cos(6 * np.pi * np.arange(s) / s)
    return 2 + slope * t + swing[t % s] + noise * np.random.default_rng(seed).normal(size=n)
