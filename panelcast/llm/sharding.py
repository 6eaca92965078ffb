"""Sharding by histogram sort: exact byte counts below probe keys, refined, then one exchange.

Rows are ordered by a 63-bit key: 43 hashed bits of the text above 20 hashed bits
of the id, so copies of a text are neighbours and stay together unless they are
too many for a shard.  Each round counts, in every task, the bytes and rows below
a few thousand probes; only these counts reach the driver.  Probes close in on
every splitter until its bytes are right to within the tolerance or a single row
is left.  A splitter then moves to an edge between texts if one is within the
tolerance.  Shards are cut into ranges of bounded rows at probes whose row counts
are known, so each row's slot is its place in its range plus a known offset.
Where more rows than a range may hold lie between two probes, such as the copies
of one text, probes are refined there too, down to the bits of the ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.session import materialize

ID_BITS = 20
TOP = 1 << 63
ROUNDS = 12


def sort_key(text: Column, row_id: Column) -> Column:
    hashed = F.shiftleft(F.shiftrightunsigned(F.xxhash64(text), 64 - 43), ID_BITS)
    return hashed.bitwiseOR(F.shiftrightunsigned(F.xxhash64(row_id), 64 - ID_BITS))


def counts_below(keyed: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with a key below each of the sorted probes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.zeros(len(probes) + 1, np.int64)
        rows = np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            place = np.searchsorted(probes, batch.column(0).to_numpy(), side="right")
            np.add.at(sizes, place, batch.column(1).to_numpy())
            rows += np.bincount(place, minlength=len(rows))
        used = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sizes[used]), pa.array(rows[used])],
                                         ["place", "bytes", "rows"])

    found = keyed.select("key", "size").mapInArrow(count, "place long, bytes long, rows long") \
        .groupBy("place").agg(F.sum("bytes"), F.sum("rows")).collect()
    sizes, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for place, b, n in found:
        sizes[place], rows[place] = b, n
    return np.cumsum(sizes)[:-1], np.cumsum(rows)[:-1]


def splitters(keyed: DataFrame, shards: int, tolerance: float = 0.005, rows_per_range: int = 20_000,
              probes_per_splitter: int = 64):
    """Range starts, their shard and the slot of their first row, as three arrays."""
    total, n_rows = (x or 0 for x in keyed.agg(F.sum("size"), F.count("*")).first())
    if not n_rows:
        return np.array([0]), np.array([0]), np.array([0])
    goals = [total * i / shards for i in range(1, shards)]
    allowed = tolerance * total / shards
    known: dict[int, tuple[int, int]] = {0: (0, 0), TOP - 1: (total, n_rows)}

    def measure(keys) -> None:
        new = np.array(sorted({int(k) for k in keys} - known.keys()), np.int64)
        if len(new):
            known.update(zip(new.tolist(), zip(*(x.tolist() for x in counts_below(keyed, new)))))

    ranges = max(1, n_rows // rows_per_range)
    even = max(shards * probes_per_splitter, 4 * ranges)
    measure(TOP * i // even for i in range(1, even))
    fair = n_rows / ranges
    at = []
    for _ in range(ROUNDS):
        ordered = sorted(known)
        sums = np.array([known[k][0] for k in ordered])
        at, refine = [], []
        for goal in goals:
            i = min(max(int(np.searchsorted(sums, goal)), 1), len(ordered) - 1)
            low, high = ordered[i - 1], ordered[i]
            best = min(low, high, key=lambda k: abs(known[k][0] - goal))
            at.append(best)
            if abs(known[best][0] - goal) > allowed and high - low > 1 and known[high][1] - known[low][1] > 1:
                refine += [low + (high - low) * j // probes_per_splitter for j in range(1, probes_per_splitter)]
        if not refine:
            break
        measure(refine)
    # Edges between texts on both sides of each splitter.
    edges = [(k >> ID_BITS << ID_BITS, min((k >> ID_BITS) + 1 << ID_BITS, TOP - 1)) for k in at]
    measure(k for pair in edges for k in pair)
    for i, (goal, pair) in enumerate(zip(goals, edges)):
        edge = min(pair, key=lambda k: abs(known[k][0] - goal))
        if abs(known[edge][0] - goal) <= max(allowed, abs(known[at[i]][0] - goal)):
            at[i] = edge
    at = sorted(at)
    for _ in range(ROUNDS):  # probes inside intervals that would be too large for one range
        ordered = sorted(known)
        heavy = [(low, high) for low, high in zip(ordered, ordered[1:])
                 if high - low > 1 and known[high][1] - known[low][1] > fair]
        if not heavy:
            break
        measure(low + (high - low) * j // probes_per_splitter for low, high in heavy for j in range(1, probes_per_splitter))
    starts, last = {0, *at}, 0
    for k in sorted(known):  # further cuts: no range holds more than twice the fair number
        if known[k][1] - last >= fair:
            starts.add(k)
            last = known[k][1]
    starts = np.array(sorted(starts - {TOP - 1}), np.int64)
    shard = np.searchsorted(np.array(at, np.int64), starts, side="right")
    rows = np.array([known[int(k)][1] for k in starts])
    shard_rows = np.array([0, *[known[k][1] for k in at]])
    return starts, shard, rows - shard_rows[shard]


def shard(docs: DataFrame, shards: int = 24, carry: list[str] | None = None, tolerance: float = 0.005) -> DataFrame:
    """Every row with its shard and slot, sizes of the shards near equal.

    ``docs`` needs ``doc_id, text``.  Returns ``row`` (struct of the columns in
    ``carry``, by default all), ``size`` (UTF-8 bytes plus 8), ``text_crc32``,
    ``shard``, ``slot``.  A NULL text counts 8 bytes and shares the checksum of
    the empty one.  Rows alike in text and id have one key and are not parted;
    their slots are interchangeable.  With fewer rows than shards some shards
    are empty; an empty table gives an empty result.
    """
    carry = docs.columns if carry is None else carry
    own = docs.select(
        F.struct(*[docs[c] for c in carry]).alias("row"), sort_key(docs["text"], docs["doc_id"]).alias("key"),
        (F.coalesce(F.octet_length(docs["text"]), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(docs["text"], F.lit("")).cast("binary")).alias("text_crc32"),
        docs["doc_id"].cast("string").alias("tie"))
    light = "text" not in carry
    if light:
        own = materialize(own, "shard-keys")
    keyed = own.select("key", "size") if light else materialize(own.select("key", "size"), "shard-keys")
    starts, shard_of, offset = splitters(keyed, shards, tolerance)

    @F.pandas_udf("int")
    def range_of(key):
        import pandas as pd
        return pd.Series(np.searchsorted(starts, key.to_numpy(), side="right") - 1).astype("int32")

    place = Window.partitionBy("range").orderBy("key", "tie", "text_crc32")
    ranges = docs.sparkSession.createDataFrame(
        [(i, int(s), int(o)) for i, (s, o) in enumerate(zip(shard_of, offset))], "range int, shard int, first long")
    # One row per range, whose number follows from rows_per_range; Spark decides by size whether to broadcast it.
    return own.withColumn("range", range_of("key")).withColumn("place", F.row_number().over(place) - 1) \
        .join(ranges, "range").select("row", "size", "text_crc32", "shard", (F.col("place") + F.col("first")).alias("slot"))
