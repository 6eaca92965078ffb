"""Streaming forms: bucketed panels, an online level filter, anomaly flags."""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from panelcast.functions.statespace_scalar import LOG_2PI
from panelcast.schemas import EVENTS, JITTER

STEP_SCHEMA = ("series_id string, ds timestamp_ntz, y double, a_pred double, p_pred double, v double, "
               "f double, a_filt double, p_filt double, loglik double, revision long, status string")
STATE_SCHEMA = "ds array<long>, y array<double>, a array<double>, p array<double>, revision long"
KEPT_STEPS = 200  # steps of a series that a late row can still reach


def read_event_stream(spark: SparkSession, folder: str, schema: str = EVENTS,
                      files_per_trigger: int = 16) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder))


def stream_bucket(events: DataFrame, key: str = "event_type", ts: str = "ts", measure: str = "value",
                  width: str = "1 hour", lateness: str = "2 hours") -> DataFrame:
    """Panel rows by tumbling window; events later than the watermark are dropped.

    The sum is combined on the map side of every micro-batch, so a hot key
    costs one state row per open window.
    """
    # A watermark needs a zoned timestamp.  The wall clock is taken as UTC and
    # turned back at the end, so windows do not depend on the session's zone.
    zone = F.current_timezone()
    stamped = events.withColumn("_ts", F.from_utc_timestamp(F.col(ts).cast("timestamp_ntz").cast("timestamp"), zone))
    return (stamped.withWatermark("_ts", lateness)
            .groupBy(F.window("_ts", width), F.col(key).alias("series_id"))
            .agg(F.sum(measure).alias("sum"), F.count("*").alias("n"))
            .select("series_id", F.to_utc_timestamp("window.start", zone).cast("timestamp_ntz").alias("ds"),
                    F.round("sum", 2).alias("y"), "n"))


def open_windows(spark: SparkSession, checkpoint: str, key: str = "event_type") -> DataFrame:
    """Windows of ``stream_bucket`` that its watermark has not closed, from the query's state: ``series_id, ds, y, n``.

    A window leaves the state when it is emitted, so emitted and open windows
    are all windows, each once.  At the end of a bounded source the open ones
    are complete as well.  Reading changes nothing: a later run goes on.
    """
    zone = F.current_timezone()
    return spark.read.format("statestore").load(checkpoint).select(
        F.col(f"key.{key}").alias("series_id"), F.to_utc_timestamp("key.window.start", zone).cast("timestamp_ntz").alias("ds"),
        F.round("value.sum", 2).alias("y"), F.col("value.count").alias("n"))


def bucket_available(events: DataFrame, path: str, checkpoint: str, key: str = "event_type", **options) -> DataFrame:
    """Process what is there and return the whole panel: emitted windows, and those still open."""
    emitted = run_available(stream_bucket(events, key, **options), path, checkpoint)
    return emitted.unionByName(open_windows(events.sparkSession, checkpoint, key))


def late_windows(events: DataFrame, panel: DataFrame, key: str = "event_type", ts: str = "ts", width: str = "1 hour") -> DataFrame:
    """Windows that lost rows to the watermark: ``series_id, ds, n_events, n_late``.

    ``events`` is the source read as a table, ``panel`` what the stream made of it.
    """
    zone = F.current_timezone()
    stamped = events.withColumn("_ts", F.from_utc_timestamp(F.col(ts).cast("timestamp_ntz").cast("timestamp"), zone))
    counted = stamped.groupBy(F.window("_ts", width), F.col(key).alias("series_id")).agg(F.count("*").alias("n_events")).select(
        "series_id", F.to_utc_timestamp("window.start", zone).cast("timestamp_ntz").alias("ds"), "n_events")
    late = F.col("n_events") - F.coalesce("n", F.lit(0))
    return counted.join(panel.select("series_id", "ds", "n"), ["series_id", "ds"], "left") \
        .withColumn("n_late", late).where("n_late > 0").drop("n")


def level_filter(q: float, h: float, a0: float = 0.0, p0: float = 1.0, kept_steps: int = KEPT_STEPS):
    """Stateful function: state is the last ``kept_steps`` steps, each with the prediction before its observation.

    Rows of a micro-batch are taken in date order.  A row between kept dates
    rolls the filter back: it and all steps after it are emitted again with a
    higher ``revision``.  ``status`` says what a row is: ``ok``, ``revised`` (a
    step emitted before, with new values), ``late`` (older than what is kept)
    or ``repeated`` (a date that was there); the last two change no state and
    carry no values, so they can be counted and kept apart.
    """
    def one(a, p, y):
        f = p + h + JITTER
        if y is None or y != y:
            return a, p, None, f, a, p + JITTER, 0.0
        v, gain = y - a, p / f
        return a, p, v, f, a + gain * v, (1 - gain) ** 2 * p + gain ** 2 * h + JITTER, -0.5 * (LOG_2PI + math.log(f) + v * v / f)

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ds, ys, priors_a, priors_p, revision = map(lambda x: list(x) if hasattr(x, "__len__") else x, state.get) \
            if state.exists else ([], [], [a0], [p0], 0)
        # One prior more than steps: the prediction of the step to come.
        rows = pd.concat(list(batches)).sort_values("ds", kind="stable")
        out, new, there = [], [], set(ds)
        for stamp, y in zip(rows["ds"], rows["y"]):
            micros = int(stamp.value // 1000)
            status = "repeated" if micros in there else "late" if len(ds) >= kept_steps and micros < ds[0] else None
            if status:
                out.append((key[0], stamp, y, *[None] * 7, revision, status))
            else:
                there.add(micros)
                new.append((micros, None if y is None or y != y else float(y)))
        if new:
            back = bisect.bisect_left(ds, new[0][0])
            fresh = {micros for micros, _ in new}
            todo = sorted([*zip(ds[back:], ys[back:]), *new], key=lambda r: r[0])
            a, p = priors_a[back], priors_p[back]
            del ds[back:], ys[back:], priors_a[back:], priors_p[back:]
            for micros, y in todo:
                row = one(a, p, y)
                out.append((key[0], pd.Timestamp(micros, unit="us"), y, *row, revision, "ok" if micros in fresh else "revised"))
                ds.append(micros)
                ys.append(y)
                priors_a.append(a)
                priors_p.append(p)
                a, p = row[4], row[5] + q
            priors_a.append(a)
            priors_p.append(p)
            cut = max(0, len(ds) - kept_steps)
            del ds[:cut], ys[:cut], priors_a[:cut], priors_p[:cut]
        state.update((ds, ys, priors_a, priors_p, revision + 1))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in STEP_SCHEMA.split(", ")])
    return step


def stream_kf_update(panel: DataFrame, q: float, h: float, a0: float = 0.0, p0: float = 1.0, kept_steps: int = KEPT_STEPS) -> DataFrame:
    """Online local-level update of each series of a bucketed panel stream, late rows included; see ``level_filter``.

    The input has one row per series and period, so the rows a task sees for
    one series are bounded by the periods in a micro-batch.
    """
    return panel.groupBy("series_id").applyInPandasWithState(
        level_filter(q, h, a0, p0, kept_steps), STEP_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)


def latest_steps(updated: DataFrame) -> DataFrame:
    """The last word on every step: rows of the highest revision, without those that changed nothing."""
    rest = [c for c in updated.columns if c not in ("series_id", "ds")]
    return updated.where("status IN ('ok', 'revised')").groupBy("series_id", "ds") \
        .agg(F.max_by(F.struct(*rest), "revision").alias("r")).select("series_id", "ds", "r.*")


def anomaly(v: Column, f: Column, k: float = 3.0) -> Column:
    return F.abs(v) > k * F.sqrt(f)


def stream_anomaly(updated: DataFrame, k: float = 3.0) -> DataFrame:
    """Flag observations more than ``k`` innovation deviations off."""
    return updated.withColumn("is_anomaly", F.coalesce(anomaly(F.col("v"), F.col("f"), k), F.lit(False)))


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Process what is there, write it to ``path`` and read the result."""
    done = (stream.writeStream.format("parquet").outputMode(mode).option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    done.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
