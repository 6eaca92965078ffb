"""Regular calendar, gap filling, hold-out split, future dates.

Every function here that needs a window partitions by ``series_id`` and orders
by ``ds``; Spark plans one exchange and one sort for any chain of them.  The
rows of a series are bounded by its calendar (one per period), never by the
number of facts behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from panelcast.functions.calendar import future_array, grid_date, ordinal, ordinal_at_or_after
from panelcast.schemas import HORIZON, MISSING_SENTINEL
from panelcast.session import spread


def by_date():
    return Window.partitionBy("series_id").orderBy("ds")


def whole():
    return Window.partitionBy("series_id")


def up_to_now():
    return by_date().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def collapse_duplicates(panel: DataFrame, how: str = "sum") -> DataFrame:
    """One row per series and date; ``n_rows`` tells how many were merged."""
    merge = {"sum": F.sum("y"), "max": F.max("y"), "mean": F.avg("y")}[how]
    return panel.groupBy("series_id", "ds").agg(merge.alias("y"), F.count("*").alias("n_rows"))


def calendar_spine(panel: DataFrame, freq: str = "W-MON") -> DataFrame:
    """All grid dates from the first to the last date of each series.

    Each row produces the grid dates from its own date up to the next row of
    the series, so no calendar is joined: one exchange by ``series_id`` serves
    this and everything after it.  Off-grid rows contribute dates but no value.

    The exchange has a given number of partitions: rows of a panel shrink to a
    few bytes when shuffled, so partitions merged by their bytes would hold
    millions of rows, which the windows sort in memory.
    """
    panel = spread(panel, "series_id")
    first = ordinal_at_or_after(F.col("ds"), freq)
    following = F.lead("ds").over(by_date())
    stop = F.coalesce(ordinal_at_or_after(following, freq) - 1, ordinal(F.col("ds"), freq))
    rows = (panel.withColumn("_first", first).withColumn("_stop", stop)
            .where(F.col("_stop") >= F.col("_first"))
            .withColumn("_on_grid", grid_date(F.col("_first"), freq) == F.col("ds"))
            .select("series_id", "y", "_first", "_on_grid",
                    F.explode(F.sequence("_first", "_stop")).alias("_n")))
    return rows.select(
        "series_id", grid_date(F.col("_n"), freq).alias("ds"),
        F.when(F.col("_on_grid") & (F.col("_n") == F.col("_first")), F.col("y")).alias("y"))


def forward_fill(panel: DataFrame, column: str = "y") -> DataFrame:
    return panel.withColumn(column, F.last(column, ignorenulls=True).over(up_to_now()))


def drop_missing(panel: DataFrame, column: str = "y") -> DataFrame:
    return panel.where(F.col(column).isNotNull() & ~F.isnan(column))


def regularize(panel: DataFrame, freq: str = "W-MON", duplicates: str = "sum") -> DataFrame:
    """Duplicates merged, grid, forward fill, leading gaps removed.

    Merging costs no exchange where the panel was just aggregated by series
    and date, as every panel derived from facts is.
    """
    unique = collapse_duplicates(panel, duplicates).drop("n_rows")
    return drop_missing(forward_fill(calendar_spine(unique, freq)))


def filter_date_range(panel: DataFrame, start: str, end: str) -> DataFrame:
    return panel.where(F.col("ds").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def infer_step_days(panel: DataFrame) -> DataFrame:
    """The commonest distance in days between neighbouring rows per series."""
    steps = panel.select("series_id", F.datediff("ds", F.lag("ds").over(by_date())).alias("step_days"))
    counted = steps.where("step_days is not null").groupBy("series_id", "step_days").count()
    return counted.groupBy("series_id").agg(
        F.max_by("step_days", F.struct(F.col("count"), -F.col("step_days"))).alias("step_days"))


def assign_frequency(panel: DataFrame, config: DataFrame) -> DataFrame:
    """``series_id, freq`` of every series: configured, or read off its dates.

    The commonest step decides: a day, a week (anchored at the weekday of the
    first date), or the days of a month, quarter or year.
    """
    step = F.col("step_days")
    weekly = F.concat(F.lit("W-"), F.upper(F.date_format("first_ds", "EEE")))
    read = (F.when(step == 1, "D").when(step == 7, weekly).when(step.between(28, 31), "M")
            .when(step.between(89, 92), "Q").when(step.between(365, 366), "Y"))
    first = panel.groupBy("series_id").agg(F.min("ds").alias("first_ds"))
    return (first.join(infer_step_days(panel), "series_id", "left")
            .join(config.select("series_id", F.col("freq").alias("configured")), "series_id", "left")
            .select("series_id", F.coalesce(F.upper("configured"), read).alias("freq")))


def time_index(panel: DataFrame, season: int) -> DataFrame:
    """Position ``t`` from 0 and season index ``t mod season``."""
    t = F.row_number().over(by_date()) - 1
    return panel.withColumn("t", t).withColumn("season_index", F.pmod("t", F.lit(season)))


def holdout_split(panel: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Mark the last ``horizon`` rows of each series as ``test``."""
    position = F.row_number().over(by_date())
    total = F.count("*").over(whole())
    return panel.withColumn("split", F.when(position > total - horizon, "test").otherwise("train"))


def tail_steps(predictions: DataFrame, steps: int) -> DataFrame:
    """Last ``steps`` rows of each series and model."""
    w = Window.partitionBy("series_id", "model").orderBy(F.col("ds").desc())
    return (predictions.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= steps).drop("_rn"))


def future_calendar(panel: DataFrame, steps: int = HORIZON, freq: str = "W-MON") -> DataFrame:
    """The next ``steps`` dates of each series with their step number."""
    last = panel.groupBy("series_id").agg(F.max("ds").alias("last"))
    dates = last.select("series_id", F.posexplode(future_array(F.col("last"), steps, freq)).alias("p", "ds"))
    return dates.select("series_id", (F.col("p") + 1).alias("step"), "ds")


def missing_mask(panel: DataFrame, column: str = "y", sentinel: float = MISSING_SENTINEL) -> DataFrame:
    """Replace missing and infinite values by the sentinel and flag them.

    A series that has both missing values and the sentinel as a real value is
    ambiguous; reading its rows raises an error.
    """
    value = F.col(column)
    missing = value.isNull() | F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    flagged = panel.withColumn("is_missing", missing)
    clash = ((F.count_if(F.col("is_missing")).over(whole()) > 0)
             & (F.count_if(value == sentinel).over(whole()) > 0))
    filled = F.when(F.col("is_missing"), F.lit(sentinel)).otherwise(value)
    return flagged.withColumn(column, F.when(
        clash, F.raise_error(F.concat(F.lit("sentinel occurs in series "), F.col("series_id"))).cast("double"))
        .otherwise(filled))


def series_profile(panel: DataFrame) -> DataFrame:
    return panel.groupBy("series_id").agg(
        F.count("*").alias("n"), F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"),
        F.percentile("y", 0.5).alias("median_y"), F.sum("y").alias("sum_y"))


def as_arrays(panel: DataFrame, value: str = "y") -> DataFrame:
    """One row per series: its dates and values in order.

    A regularized series has one row per calendar period, which bounds the
    arrays.  Candidates are attached after this step, never before.
    """
    ordered = F.sort_array(F.collect_list(F.struct("ds", F.col(value).alias("v"))))
    return (panel.groupBy("series_id").agg(ordered.alias("_p"))
            .select("series_id", F.col("_p.ds").alias("ds"), F.col("_p.v").alias(value)))
