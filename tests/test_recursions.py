import itertools
import time

import pytest
from pyspark.sql import functions as F

from panelcast.functions.recursions import scan, stepped


def running(spark, lists):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "id int, v array<double>")
    step = lambda s, v: stepped(s + F.coalesce(v, F.lit(0.0)), s)
    return rows.select("id", scan(F.col("v"), F.lit(0.0), step, "double").alias("r"))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 8, 9, 10, 99, 100, 101])
def test_scan_emits_one_output_per_element(spark, n):
    values = [float(i * i % 7) if i % 5 else None for i in range(n)]
    row = running(spark, [values]).first()["r"]
    sums = list(itertools.accumulate((v or 0.0 for v in values), initial=0.0))
    assert (row["state"], row["out"]) == (sums[-1], sums[:-1])


def test_scan_of_a_missing_array_is_missing(spark):
    rows = running(spark, [None, [1.0]]).select("id", "r.out").collect()
    assert {r["id"]: r["out"] for r in rows} == {0: None, 1: [0.0]}


def test_scan_time_does_not_grow_with_the_square_of_the_length(spark):
    def seconds(n):
        long = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.sin(i.cast("double")))
        rows = spark.range(4).select(long.alias("v"))
        step = lambda s, v: stepped(s + v, s)
        started = time.perf_counter()
        rows.select(F.size(scan(F.col("v"), F.lit(0.0), step, "double")["out"]).alias("n")).agg(F.sum("n")).collect()
        return time.perf_counter() - started
    seconds(1000)
    assert seconds(40_000) < 8 * max(seconds(10_000), 0.5)
