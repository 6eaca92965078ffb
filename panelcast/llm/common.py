"""What several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from panelcast.session import materialize

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words between ASCII blanks; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def by_bytes(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``limit`` bytes; a longer text is a slice of its own."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def bytes_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [b"" if t is None else t for t in batch.column(column).cast(pa.binary()).to_pylist()]


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """Adds ``place``, the rank from 0 of every row in ``order``, by one exchange by range.

    Rows are numbered inside sorted ranges, and the rows of the ranges before are
    added.  ``order`` should not leave many rows equal, as these share a range.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(np.arange(nth, nth + batch.num_rows))],
                [*batch.schema.names, "part", "nth"])
            nth += batch.num_rows

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    held = materialize(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                       .mapInArrow(number, f"{schema}, part int, nth long"), "numbered")
    firsts, before = [], 0
    for part, n in sorted(held.groupBy("part").count().collect()):  # one row per range
        firsts.append((part, before))
        before += n
    firsts = spark.createDataFrame(firsts, "part int, first long")
    return held.join(firsts, "part").withColumn("place", F.col("first") + F.col("nth")).drop("part", "nth", "first")
