"""Nearest neighbours by shifted space-filling curves.

Every vector is projected at random onto a few dimensions, shifted, and placed on
a Hilbert curve; several such orderings are made.  An ordering is cut into
segments of equal share at quantiles of its keys.  A query is compared with the
vectors of its own segment and the two beside it, in every ordering; the nearest
of each are merged and ranked by their exact inner product.

Projections and quantiles are fitted on a bounded sample, every vector is placed.
Segments are cut into tiles of bounded size, so a vector that occurs a million
times fills many tiles and not one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.session import materialize

FIT_SAMPLE = 5_000
ORDERINGS, SEGMENTS, DIMENSIONS, BITS = 12, 20, 8, 7


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer points (rows) with ``bits`` bits per dimension.

    The axes are rotated and reflected bit by bit from the top, then Gray-coded
    (the public transposed form of the curve); the key interleaves the result.
    """
    x = np.ascontiguousarray(points.T.astype(np.int64))
    d = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(d):
            inside = (x[i] >> bit & 1).astype(bool)
            swap = np.where(inside, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(inside, low, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[d - 1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | (x[i] >> bit & 1)
    return key


class Curves:
    """The orderings: projections, scales, shifts and the segments' bounds."""

    def __init__(self, sample: np.ndarray, orderings: int, segments: int, dimensions: int, bits: int, seed: int):
        rng = np.random.default_rng(seed)
        size = min(dimensions, sample.shape[1])
        self.bits, self.segments = bits, segments
        self.projections = [np.linalg.qr(rng.normal(size=(sample.shape[1], size)))[0] for _ in range(orderings)]
        self.shifts = rng.random((orderings, size)) / 2
        placed = [sample @ p for p in self.projections]
        self.lows = [p.min(axis=0) for p in placed]
        self.spans = [np.maximum(np.ptp(p, axis=0), 1e-300) for p in placed]
        cuts = np.arange(1, segments) / segments
        # Equal bounds count once: a vector that many rows share would leave empty segments beside its own.
        self.bounds = [np.unique(np.quantile(self.keys(sample, o), cuts, method="nearest")) for o in range(orderings)]

    def keys(self, vectors: np.ndarray, ordering: int) -> np.ndarray:
        unit = (vectors @ self.projections[ordering] - self.lows[ordering]) / self.spans[ordering] / 2
        grid = np.clip((unit + self.shifts[ordering]) * (1 << self.bits), 0, (1 << self.bits) - 1)
        return hilbert_keys(grid.astype(np.int64), self.bits)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """For every vector and ordering: ordering times segments plus segment."""
        return np.stack([o * self.segments + np.searchsorted(b, self.keys(vectors, o), side="right")
                         for o, b in enumerate(self.bounds)], axis=1)


def _matrix(vectors: pa.Array, size: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def usable(vectors: DataFrame, size: int) -> DataFrame:
    """Rows whose vector has ``size`` finite components, not all of them zero."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(v.isNotNull() & (F.size(v) == size)).filter(finite & F.exists(v, lambda x: x != 0))


def place(vectors: DataFrame, curves: Curves, size: int) -> DataFrame:
    """``id, vector, query`` with the array ``cells``."""
    def map_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = curves.cells(_matrix(batch.column("vector"), size)) if batch.num_rows else np.empty((0, 1), np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(cells) + 1, dtype=np.int32) * cells.shape[1]),
                                             pa.array(cells.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "cells"])

    return vectors.mapInArrow(map_batches, "id long, vector array<double>, query boolean, cells array<int>")


def _tiles(rows: DataFrame, per_tile: int) -> DataFrame:
    """``cell, ids, vectors`` of tiles with about ``per_tile`` rows."""
    sizes = rows.groupBy("cell").agg(F.ceil(F.count("*") / per_tile).alias("chunks"))
    # sizes has one row per ordering and segment
    return rows.join(sizes, "cell").withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks")).groupBy("cell", "chunk") \
        .agg(F.collect_list(F.struct("id", "vector")).alias("rows")) \
        .select("cell", F.col("rows.id").alias("ids"), F.col("rows.vector").alias("vectors"))


def best_of_tile(query_ids, queries, ids, vectors, k: int):
    """The k nearest of a tile for each query: query number, id and score, ordered by query, score, id.

    A matrix product finds who can be among them; the scores are then summed
    component by component, so equal vectors have equal scores everywhere.
    Rows of one id share a tile; the id's best score counts.
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    rough = queries @ vectors.T
    own = query_ids[:, None] == ids[None, :]
    rough[own] = -np.inf
    starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    by_id = rough if len(starts) == len(ids) else np.maximum.reduceat(rough, starts, axis=1)
    if len(starts) > k:
        least = np.partition(by_id, len(starts) - k, axis=1)[:, len(starts) - k]
    else:
        least = np.full(len(queries), -np.inf)
    slack = 1e-9 * (np.abs(queries).max(axis=1) * np.abs(vectors).max() * queries.shape[1] + 1e-300)
    q, c = np.nonzero((rough >= (least - slack)[:, None]) & ~own)
    score = np.zeros(len(q))
    for i in range(queries.shape[1]):
        score += queries[q, i] * vectors[c, i]
    if len(starts) < len(ids):
        order = np.lexsort((-score, ids[c], q))
        q, c, score = q[order], c[order], score[order]
        best = np.r_[True, (q[1:] != q[:-1]) | (ids[c[1:]] != ids[c[:-1]])][:len(q)]
        q, c, score = q[best], c[best], score[best]
    order = np.lexsort((ids[c], -score, q))
    q, c, score = q[order], c[order], score[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q, side="left")
    return q[rank < k], ids[c[rank < k]], score[rank < k]


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            orderings: int = ORDERINGS, segments: int = SEGMENTS, dimensions: int = DIMENSIONS, bits: int = BITS,
            sample: int = FIT_SAMPLE, seed: int = 9, tile: int = 2048) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest inner products found for each query row.

    Vectors that are NULL, zero, of another length than most of the sample, or hold NULL
    or non-finite components take no part, nor do rows without an id.  Ids name
    vectors: a candidate with the query's id is its own, repeated rows count
    once, and rows that share an id with different vectors are one candidate (and
    one query) whose score is the largest of its vectors'.  Ties go to the smaller id.  A segment never holds fewer than 4 k rows on
    average, so with k candidates or fewer all are found.  An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    named = vectors.select(vectors[id_col].cast("long").alias("id"),
                           vectors[vector_col].cast("array<double>").alias("vector"), is_query.alias("query")) \
        .filter("id IS NOT NULL")
    lengths = named.filter("vector IS NOT NULL").groupBy(F.size("vector").alias("n")).count() \
        .orderBy(F.desc("count"), "n").first()
    size = lengths["n"] if lengths else 1
    own = usable(named, size)
    fit = own.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(sample).select("vector").toArrow()
    if not fit.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    segments = max(1, min(segments, own.count() // (4 * k)))  # a segment holds 4 k rows or more
    curves = Curves(_matrix(fit.column(0).combine_chunks(), size), orderings, segments, dimensions, bits, seed)
    placed = materialize(place(own, curves, size), "placed")
    candidates = materialize(_tiles(placed.select(F.explode("cells").alias("cell"), "id", "vector"), tile), "candidate-tiles")
    beside = F.filter(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda s: s + F.col("at")),
                      lambda c: F.floor(c / segments) == F.floor(F.col("at") / segments))
    asked = placed.filter("query").select(F.explode("cells").alias("at"), "id", "vector") \
        .select(F.explode(beside).alias("cell"), "id", "vector").distinct()
    queries = materialize(_tiles(asked, tile // 4), "query-tiles")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                query_ids, query_vectors, ids, rows = (batch.column(c)[r].values for c in range(4))
                query_ids = query_ids.to_numpy()
                q, found, score = best_of_tile(query_ids, _matrix(query_vectors, size), ids.to_numpy(), _matrix(rows, size), k)
                cuts = np.searchsorted(q, np.arange(len(query_ids) + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x)) for x in (found, score)]
                yield pa.RecordBatch.from_arrays([pa.array(query_ids), *lists], ["query_id", "ids", "scores"])

    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = queries.select("cell", F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors")) \
        .join(candidates, "cell").select("query_ids", "query_vectors", "ids", "vectors").repartition(parallel)
    partial = pairs.mapInArrow(compare, "query_id long, ids array<long>, scores array<double>")

    def merge(group: pa.Table) -> pa.Table:
        flat = [np.concatenate([c.flatten().to_numpy() for c in group.column(name).chunks]) for name in ("ids", "scores")]
        order = np.lexsort((-flat[1], flat[0]))
        ids, first = np.unique(flat[0][order], return_index=True)
        score = flat[1][order][first]
        top = np.lexsort((ids, -score))[:k]
        return pa.table({"query_id": pa.array(np.full(len(top), group.column("query_id")[0].as_py())),
                         "rank": pa.array(np.arange(1, len(top) + 1, dtype=np.int32)),
                         "vec_id": pa.array(ids[top]), "score": pa.array(score[top])})

    return partial.groupBy("query_id").applyInArrow(merge, "query_id long, rank int, vec_id long, score double")
