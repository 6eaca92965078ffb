"""Fitted parameters by content: what was fitted once is read, by whichever job asks for it.

A row's key digests all that its fit depends on: the series' name, dates and
values, the family, its grid, draws and seed.  A job joins its keys to the store
and fits only what is missing, so a run that lost its driver goes on where it
stopped, and changed values are new work without any bookkeeping.

The store is a folder of parts.  A part is one write with Spark's own commit;
only committed parts are read, so writers need no lock and a half-written part is
not seen.  Two jobs that fit the same row at once leave two rows with one key, of
which the reader takes one: the fits are seeded and equal.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelcast.session import materialize, shared_dir

STORED = ("key string, series_id string, model string, candidate_id int, params map<string,string>, coef array<double>, "
          "n bigint, score double, status string")
NAMES = [field.split()[0] for field in STORED.split(", ")]


def default_store(spark: SparkSession) -> str:
    """The store of the session's shared folder."""
    return f"{shared_dir(spark)}/param-store"


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def committed(spark: SparkSession, path: str) -> bool:
    files, folder = _file_system(spark, f"{path}/_SUCCESS")
    return files.exists(folder)


def committed_parts(spark: SparkSession, path: str) -> list[str]:
    """Folders below ``path`` whose write has ended; one per earlier write."""
    files, folder = _file_system(spark, path)
    if not files.exists(folder):
        return []
    return sorted(p for p in (str(s.getPath()) for s in files.listStatus(folder)) if committed(spark, p))


def read_params(spark: SparkSession, path: str) -> DataFrame:
    """One row per key."""
    parts = committed_parts(spark, path)
    if not parts:
        return spark.createDataFrame([], STORED)
    rows = spark.read.schema(STORED).parquet(*parts)
    rest = [c for c in NAMES if c != "key"]
    # Equal but for the sums' last bits: the first by score and number.
    return rows.groupBy("key").agg(F.min_by(F.struct(*rest), F.struct("score", "candidate_id")).alias("r")).select("key", "r.*")


def append_params(rows: DataFrame, path: str) -> None:
    missing = {c: F.lit(None) for c in NAMES if c not in rows.columns}
    kinds = {f.split()[0]: f.split(" ", 1)[1] for f in STORED.split(", ")}
    rows.withColumns(missing).select(*[F.col(c).cast(kinds[c]).alias(c) for c in NAMES]).write.parquet(f"{path}/part-{uuid.uuid4().hex}")


def content_key(*settings) -> Column:
    """Digest of a series row (``series_id, ds, z``) and the settings of a fit."""
    values = F.array_join(F.transform("z", lambda v: v.cast("string")), ",", "null")
    dates = F.array_join(F.transform("ds", lambda v: v.cast("string")), ",", "null")
    return F.sha2(F.concat_ws("|", F.lit(repr(settings)), "series_id", dates, values), 256)


def load_or_fit(arrays: DataFrame, model: str, settings: tuple, fit: Callable[[DataFrame], DataFrame],
                path: str | None = None) -> DataFrame:
    """Best candidates of the series in ``arrays``: stored ones, and fits of those that are not stored.

    ``fit`` gets the rows without an entry and returns at most one row for each.
    Series that it gives none for are stored as failed, so that they are not
    tried again.  A store in which nothing is missing starts no fit.
    """
    spark = arrays.sparkSession
    path = path or default_store(spark)
    # Written, as three jobs read it: a key is a digest of the whole text of a series.
    keyed = materialize(arrays.withColumn("key", content_key(model, *settings)), f"keyed-{model}")
    missing = keyed.join(read_params(spark, path).select("key"), "key", "left_anti")
    if not missing.isEmpty():
        fitted = fit(missing.drop("key"))
        given = [c for c in NAMES if c in fitted.columns and c not in ("key", "series_id", "status", "model")]
        status = F.coalesce(F.col("status") if "status" in fitted.columns else F.when(F.col("fits"), F.lit("ok")),
                            F.lit("failed: no candidate could be fitted"))
        rows = missing.select("key", "series_id").join(fitted.withColumn("fits", F.lit(True)).drop("model"), "series_id", "left")
        append_params(rows.select("key", "series_id", F.lit(model).alias("model"), *given, status.alias("status")), path)
    found = read_params(spark, path).where("status = 'ok'").drop("series_id")
    return keyed.select("key", "series_id").join(found, "key").drop("key")
