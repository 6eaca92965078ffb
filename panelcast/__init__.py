"""panelcast: forecasting over panels of time series, written as Spark jobs.

The unit of data is a *panel*: a long DataFrame ``(series_id, ds, y)`` on a
regular calendar.  Everything in the package maps DataFrames to DataFrames.
"""

__version__ = "0.1.0"
