"""Configuration, search log, model store and result exports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelcast.schemas import SEARCH_LOG
from panelcast.sources.param_store import committed_parts

DEFAULT_FORMAT = "%Y-%m-%d"


# --- series configuration -------------------------------------------------

def parse_series_config(documents: DataFrame, text: str = "value") -> DataFrame:
    """JSON documents ``{series: {format, freq, freq_type}}`` as rows."""
    entries = F.from_json(F.col(text), "map<string,struct<format:string,freq:string,freq_type:string>>")
    return (documents.select(F.explode(entries).alias("series_id", "c"))
            .select("series_id", F.coalesce("c.format", F.lit(DEFAULT_FORMAT)).alias("format"),
                    F.col("c.freq").alias("freq"), F.col("c.freq_type").alias("freq_type")))


def read_series_config(spark: SparkSession, path: str) -> DataFrame:
    """The configuration file as a table; a missing file is an empty table."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    documents = (spark.read.text(path, wholetext=True) if exists
                 else spark.createDataFrame([], "value string"))
    return parse_series_config(documents)


def upsert_series_config(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Entries of ``changes`` replace or extend those of ``current``."""
    both = (current.withColumn("recency", F.lit(0))
            .unionByName(changes.withColumn("recency", F.lit(1))))
    entry = F.max_by(F.struct("format", "freq", "freq_type"), "recency").alias("e")
    return both.groupBy("series_id").agg(entry).select("series_id", "e.*")


# --- search log and parameters --------------------------------------------

def search_log_rows(best: DataFrame, stamp: Column, model: str) -> DataFrame:
    """Log rows from ``best(series_id, params, score, n_samples)``."""
    return best.select(
        F.date_format(stamp, "yyyy-MM-dd_HH-mm-ss").alias("date"), F.lit(model).alias("model"),
        F.col("params").alias("best_params"), F.col("score").alias("best_score"),
        F.struct(F.col("n_samples").cast("bigint").alias("n_samples"),
                 F.concat_ws("_", "series_id", F.lit(model)).alias("dataset_name_and_type"))
        .alias("dataset_info"))


def append_search_log(rows: DataFrame, path: str) -> None:
    """One more part of the log.  Writers need no lock; a part is seen once its write has ended."""
    rows.write.parquet(f"{path}/part-{uuid.uuid4().hex}")


def read_search_log(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all ended appends; a log that was never written is empty."""
    parts = committed_parts(spark, path)
    return spark.read.schema(SEARCH_LOG).parquet(*parts) if parts else spark.createDataFrame([], SEARCH_LOG)


def latest_best_params(log: DataFrame, keep_null: bool = False) -> DataFrame:
    """Parameters of the most recent log row per dataset and model.

    Parameters, score and date are those of one row; of rows with equal dates
    that with the smallest score is taken.  Parameters that are NULL are
    dropped unless ``keep_null``.
    """
    newest = F.max_by(F.struct("best_params", "date", "best_score"), F.struct("date", -F.col("best_score")))
    latest = log.groupBy(F.col("dataset_info.dataset_name_and_type").alias("dataset"), F.lower("model").alias("model")).agg(
        newest.alias("r")).select("dataset", "model", "r.best_params", "r.date", "r.best_score")
    if keep_null:
        return latest
    return latest.withColumn("best_params", F.map_filter("best_params", lambda _, v: v.isNotNull()))


def series_to_fit(series: DataFrame, stored: DataFrame, model: str) -> DataFrame:
    """Series that have no stored parameters for ``model``."""
    done = stored.where(F.col("model") == model).select("series_id")
    return series.join(done, "series_id", "left_anti")


def model_store_load_or_fit(panel: DataFrame, stored: DataFrame, model: str, fit) -> DataFrame:
    """Stored rows plus rows fitted for the series that had none."""
    return (stored.where(F.col("model") == model)
            .unionByName(fit(series_to_fit(panel, stored, model)), allowMissingColumns=True))


# --- exports ---------------------------------------------------------------

def predictions_wide(actuals: DataFrame, predictions: DataFrame, kind: str,
                     models: list[str]) -> DataFrame:
    """Dates by models for one kind of prediction, next to ``y_true``.

    Naming the models keeps the pivot to one aggregation.  Rows of a date
    without a fit (the start of a lag model) stay, with NULL.
    """
    rows = (actuals.select("series_id", "ds", F.lit("y_true").alias("model"), F.col("y").alias("yhat"))
            .unionByName(predictions.where(F.col("kind") == kind)
                         .select("series_id", "ds", "model", "yhat")))
    wide = rows.groupBy("series_id", "ds").pivot("model", ["y_true", *models]).agg(F.first("yhat"))
    return wide.where(F.col("y_true").isNotNull())


def export_fits_wide(actuals: DataFrame, predictions: DataFrame, models: list[str]) -> DataFrame:
    return predictions_wide(actuals, predictions, "fitted", models)


def export_forecasts_wide(actuals: DataFrame, predictions: DataFrame, models: list[str]) -> DataFrame:
    return predictions_wide(actuals, predictions, "forecast", models)


def write_per_series(wide: DataFrame, path: str, fmt: str = "csv") -> None:
    """One folder per series, rows of a series in date order."""
    (wide.repartition("series_id").sortWithinPartitions("series_id", "ds")
     .write.mode("overwrite").option("header", True).partitionBy("series_id").format(fmt).save(path))


def union_results(*results: DataFrame) -> DataFrame:
    out = results[0]
    for other in results[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def export_metrics(training: DataFrame, testing: DataFrame, path: str | None = None) -> DataFrame:
    """Training and testing results as one table; written when a path is given."""
    both = union_results(training.withColumn("phase", F.lit("training")),
                         testing.withColumn("phase", F.lit("testing")))
    if path is not None:
        both.write.mode("overwrite").partitionBy("phase").parquet(path)
    return both


def union_backtest_future(backtest: DataFrame, future: DataFrame) -> DataFrame:
    return backtest.unionByName(future, allowMissingColumns=True)


def export_best_model(backtest: DataFrame, future: DataFrame) -> DataFrame:
    """Back-test rows of the best model and its future rows, with page names.

    ``backtest(series_id, ds, y, yhat)``; ``future(series_id, ds, yhat,
    lower, upper, confidence)``.
    """
    return (union_backtest_future(
        backtest.select("series_id", "ds", "y", "yhat"),
        future.select("series_id", "ds", F.col("yhat").alias("future"), "confidence"))
        .withColumnsRenamed({"y": "actual", "yhat": "model_fit", "future": "forecast", "ds": "date"})
        .select("series_id", "date", "actual", "model_fit", "forecast", "confidence"))


