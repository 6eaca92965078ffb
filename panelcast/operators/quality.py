"""The data gate: which series may enter the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelcast.functions.calendar import grid_date, ordinal
from panelcast.schemas import MIN_ROWS


def dq_verdict(panel: DataFrame, freq: str = "W-MON", min_rows: int = MIN_ROWS,
               layout: DataFrame | None = None) -> DataFrame:
    """One row per series with a flag per rule and the overall verdict.

    ``layout(series_id, is_csv, first_column, n_value_columns)`` adds the rules
    on the file itself.  Duplicate and off-grid dates are counted only; a row
    without a date (or with one that could not be read) rejects its series.
    """
    per_date = panel.groupBy("series_id", "ds").agg(F.count("*").alias("c"), F.count("y").alias("v"))
    off_grid = grid_date(ordinal(F.col("ds"), freq), freq) != F.col("ds")
    verdict = per_date.groupBy("series_id").agg(
        F.sum("c").alias("n_rows"),
        F.sum(F.col("c") - 1).alias("n_duplicates"),
        F.coalesce(F.sum(F.when(off_grid, F.col("c"))), F.lit(0)).alias("n_off_grid"),
        (F.sum("c") >= min_rows).alias("enough_rows"),
        (F.sum("v") > 0).alias("has_values"),
        (F.count("ds") == F.count("*")).alias("all_dated"))
    if layout is None:
        return verdict.withColumn("ok", F.col("enough_rows") & F.col("has_values") & F.col("all_dated"))
    rules = layout.select("series_id", "is_csv", (F.col("n_value_columns") == 1).alias("one_value_column"),
                          (F.col("first_column") == "date").alias("date_first"))
    joined = rules.join(verdict, "series_id", "left").na.fill(False, ["enough_rows", "has_values", "all_dated"])
    return joined.withColumn("ok", F.col("is_csv") & F.col("one_value_column") & F.col("date_first")
                             & F.col("enough_rows") & F.col("has_values") & F.col("all_dated"))


def dq_gate(panel: DataFrame, verdict: DataFrame, strict: bool = False) -> DataFrame:
    """Rows of accepted series.  Strict: one rejected series stops the job."""
    good = verdict
    if strict:
        message = F.concat(F.lit("series rejected by the data gate: "), F.col("series_id"))
        good = verdict.withColumn("ok", F.when(F.col("ok"), True).otherwise(
            F.raise_error(message).cast("boolean")))
    return panel.join(good.where("ok").select("series_id"), "series_id", "left_semi")
