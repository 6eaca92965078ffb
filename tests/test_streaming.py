"""Late rows, revisions and the end of a bounded stream."""

import time

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from panelcast.functions import statespace_scalar as scalar
from panelcast.streaming import online

SCHEMA = "series_id string, ds timestamp_ntz, y double"


def filtered(spark, folder, parts, kept, out):
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    return online.run_available(online.stream_kf_update(stream, .1, .5, kept_steps=kept), f"{out}/out", f"{out}/state")


def test_late_steps_roll_the_filter_back(spark, tmp_path):
    n, rng = 60, np.random.default_rng(4)
    rows = pd.DataFrame({"series_id": "a", "ds": pd.date_range("2024-01-01", periods=n, freq="h"), "y": rng.normal(size=n)})
    late, first = rows.iloc[[25, 27, 38]], rows.iloc[:45].drop(index=[25, 27, 38])
    parts = [first, late, pd.concat([rows.iloc[45:], rows.iloc[[44]]])]
    updated = filtered(spark, str(tmp_path / "in"), parts, 200, str(tmp_path))
    assert {r[0]: r[1] for r in updated.groupBy("status").count().collect()} == {"ok": 60, "revised": 17, "repeated": 1}
    got = online.latest_steps(updated).orderBy("ds").toPandas()
    z = spark.createDataFrame([(rows.y.tolist(),)], "z array<double>")
    kf = z.select(scalar.filter_array(F.col("z"), F.lit(.1), F.lit(.5), F.lit(0.0), F.lit(1.0)).alias("kf")).first()["kf"]
    assert np.allclose(got.a_filt, [s["a_filt"] for s in kf]) and np.allclose(got.loglik, [s["loglik"] for s in kf])


def test_steps_older_than_what_is_kept_are_told_apart(spark, tmp_path):
    rows = pd.DataFrame({"series_id": "a", "ds": pd.date_range("2024-01-01", periods=30, freq="h"), "y": 1.0})
    parts = [rows.drop(index=[2, 25]), rows.iloc[[2, 25]]]
    updated = filtered(spark, str(tmp_path / "in"), parts, 10, str(tmp_path))
    assert {r[0]: r[1] for r in updated.groupBy("status").count().collect()} == {"ok": 29, "revised": 4, "late": 1}
    assert updated.where("status = 'late'").select("ds", "a_filt").collect() == [(pd.Timestamp("2024-01-01 02:00"), None)]
    assert online.latest_steps(updated).count() == 29


def test_the_last_windows_are_closed_and_late_events_counted(spark, tmp_path):
    schema, folder = "event_type string, ts timestamp_ntz, value double", str(tmp_path / "in")
    at = lambda h, m=0: (pd.Timestamp("2024-03-01") + pd.Timedelta(hours=h, minutes=m)).to_pydatetime()
    batches = [[("a", at(0), 1.0), ("a", at(0, 59), 2.0), ("b", at(1), 4.0)], [("a", at(8), 8.0)], [("a", at(9, 30), 16.0)], [("a", at(0, 5), 32.0)]]
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)
    events = online.read_event_stream(spark, folder, schema, files_per_trigger=1)
    panel = online.bucket_available(events, str(tmp_path / "out"), str(tmp_path / "state"), lateness="1 hour")
    seen = sorted((r["series_id"], r["ds"].hour, r["y"], r["n"]) for r in panel.collect())
    assert seen == [("a", 0, 3.0, 2), ("a", 8, 8.0, 1), ("a", 9, 16.0, 1), ("b", 1, 4.0, 1)]
    lost = online.late_windows(spark.read.schema(schema).parquet(folder), panel).collect()
    assert [(r["series_id"], r["ds"].hour, r["n_events"], r["n_late"]) for r in lost] == [("a", 0, 3, 1)]
    # A later run goes on from the same state: open windows were read, not taken.
    spark.createDataFrame([("a", at(9, 45), 1.0), ("b", at(20), 2.0)], schema).coalesce(1).write.mode("append").parquet(folder)
    again = online.bucket_available(online.read_event_stream(spark, folder, schema, files_per_trigger=1),
                                    str(tmp_path / "out"), str(tmp_path / "state"), lateness="1 hour")
    assert sorted((r["series_id"], r["ds"].hour, r["y"]) for r in again.collect()) == [
        ("a", 0, 3.0), ("a", 8, 8.0), ("a", 9, 17.0), ("b", 1, 4.0), ("b", 20, 2.0)]
