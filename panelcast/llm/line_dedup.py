"""Line deduplication by a sharded minimal perfect hash.

A line's key is its text without blanks at the ends, in lower case; a key is
hashed to 128 bits.  One aggregate over the hashes gives each line's first
document and the number of rows that hold it.  The distinct lines of several
documents go to shards, and every shard becomes a minimal perfect hash with three
arrays behind it: 64-bit fingerprints, counts and first documents.

Documents do not join lines.  A task packs the hashes of its lines by shard and
sends the packs to the shards' arrays; a shard that many lines probe (a line that
a third of the documents hold) is copied, so that each copy is probed by about as
many lines.  Back come only the lines to drop, to the rows that hold them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm import perfect_hash
from panelcast.llm.common import by_bytes, bytes_of
from panelcast.session import materialize

NO_ID = (1 << 63) - 1  # stands for a NULL id, after all others
PROBE = np.dtype([("high", "<u8"), ("low", "<u8"), ("owner", "<i8"), ("check", "<i8"), ("line", "<i4")])
BUFFERED_LINES = 400_000


def keyed_lines(text: bytes, least_chars: int) -> Iterator[tuple[int, bytes]]:
    """Number and 128-bit hash of the lines whose key is long enough."""
    for i, line in enumerate(text.split(b"\n")):
        key = line.strip().lower()  # both by ASCII only
        if len(key) >= least_chars and (key.isascii() or len(key.decode()) >= least_chars):
            yield i, xxhash.xxh3_128_digest(key)


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def line_hashes(docs: DataFrame, least_chars: int) -> DataFrame:
    """``high, low, owner``: each row's lines, once per row."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                digests, owners = [], []
                for owner, text in zip(part.column("owner").to_pylist(), bytes_of(part, "text")):
                    found = {d for _, d in keyed_lines(text, least_chars)}
                    digests += found
                    owners += [owner] * len(found)
                high, low = _halves(digests)
                yield pa.RecordBatch.from_arrays([pa.array(high.view(np.int64)), pa.array(low.view(np.int64)),
                                                  pa.array(owners, pa.int64())], ["high", "low", "owner"])

    return docs.select("owner", "text").mapInArrow(read, "high long, low long, owner long")


def build_index(lines: DataFrame, shards: int) -> DataFrame:
    """One row per shard of the repeated lines ``high, low, first, n``: the hash and its three arrays."""
    def make(group: pa.Table) -> pa.Table:
        column = lambda name: group.column(name).to_numpy()
        high, low = column("high").view(np.uint64), column("low").view(np.uint64)
        function = perfect_hash.build(high, low)
        at = perfect_hash.find(function, high, low)
        prints, counts, firsts = np.empty(len(at), np.uint64), np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        prints[at], counts[at], firsts[at] = low, column("n"), column("first")
        return pa.table({"shard": pa.array([int(group.column("shard")[0].as_py())], pa.int32()), "function": [function],
                         "prints": [prints.tobytes()], "counts": [counts.tobytes()], "firsts": [firsts.tobytes()]})

    return lines.withColumn("shard", F.pmod("high", F.lit(shards)).cast("int")).groupBy("shard") \
        .applyInArrow(make, "shard int, function binary, prints binary, counts binary, firsts binary")


def probe(index: dict, probes: np.ndarray) -> np.ndarray:
    """First document of each probed line that the index holds; NO_ID for others."""
    at = perfect_hash.find(index["function"], probes["high"].copy(), probes["low"].copy())
    prints, counts, firsts = (np.frombuffer(index[k], t) for k, t in
                              (("prints", "<u8"), ("counts", "<i8"), ("firsts", "<i8")))
    known = (at >= 0) & (prints[at] == probes["low"])
    return np.where(known & (counts[at] > 1), firsts[at], NO_ID)


def lines_to_drop(docs: DataFrame, least_chars: int = 10) -> DataFrame:
    """``owner, check, dropped``: the numbers of the lines that each row loses; rows that lose none are left out."""
    spark = docs.sparkSession
    lines = materialize(
        line_hashes(docs, least_chars).groupBy("high", "low")
        .agg(F.min("owner").alias("first"), F.max("owner").alias("last"), F.count("*").alias("n")), "lines")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(shards, (lines.filter("first < last").count() + 199_999) // 200_000)
    index = materialize(build_index(lines.filter("first < last"), shards), "line-index")
    # Copies of each shard, from the exact number of lines that will probe it.
    load = lines.groupBy(F.pmod("high", F.lit(shards)).cast("int").alias("shard")).agg(F.sum("n").alias("load"))
    # One row per shard: the number of shards follows from that of the repeated lines, 200,000 to a shard.
    loads = dict(load.collect())
    usual = max(1, sum(loads.values()) // shards)
    copies = np.array([max(1, -(-loads.get(s, 0) // (2 * usual))) for s in range(shards)])
    first_copy = np.concatenate([[0], np.cumsum(copies)])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs: dict[int, list[np.ndarray]] = defaultdict(list)
        held, turn = 0, 0

        def flush() -> pa.RecordBatch:
            places = list(packs)
            out = pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int32()), pa.array([b"".join(x.tobytes() for x in packs[p]) for p in places], pa.binary())],
                ["copy", "probes"])
            packs.clear()
            return out

        for batch in batches:
            for part in by_bytes(batch, "text"):
                digests, owners, checks, numbers = [], [], [], []
                for owner, check, text in zip(part.column("owner").to_pylist(), part.column("check").to_pylist(),
                                              bytes_of(part, "text")):
                    for number, digest in keyed_lines(text, least_chars):
                        digests.append(digest)
                        owners.append(owner)
                        checks.append(check)
                        numbers.append(number)
                probes = np.empty(len(digests), PROBE)
                probes["high"], probes["low"] = _halves(digests)
                probes["owner"], probes["check"], probes["line"] = owners, checks, numbers
                shard = np.mod(probes["high"].view(np.int64) if probes["high"].flags.c_contiguous
                               else probes["high"].copy().view(np.int64), shards)
                copy = first_copy[shard] + (np.arange(len(shard)) + turn) % copies[shard]
                turn += len(shard)
                order = np.argsort(copy, kind="stable")
                cuts = np.flatnonzero(np.diff(copy[order])) + 1
                for rows in np.split(order, cuts):
                    if len(rows):
                        packs[int(copy[rows[0]])].append(probes[rows])
                held += len(probes)
                if held > BUFFERED_LINES:
                    yield flush()
                    held = 0
        yield flush()

    copied = np.repeat(np.arange(shards), copies)

    def answer(_, left: pa.Table, right: pa.Table) -> pa.Table:
        owners, checks, dropped = [], [], []
        if right.num_rows:
            index_row = right.slice(0, 1).to_pylist()[0]
            for pack in left.column("probes"):
                probes = np.frombuffer(pack.as_buffer(), PROBE)
                lost = probes[probe(index_row, probes) < probes["owner"]]
                owners.append(lost["owner"])
                checks.append(lost["check"])
                dropped.append(lost["line"])
        join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.empty(0, kind), pa.from_numpy_dtype(kind))
        return pa.table({"owner": join(owners, np.int64), "check": join(checks, np.int64), "line": join(dropped, np.int32)})

    numbered = spark.createDataFrame([(int(s), c) for c, s in enumerate(copied)], "shard int, copy int")
    arrays = index.join(numbered, "shard").drop("shard")
    packs = docs.select("owner", "check", "text").mapInArrow(send, "copy int, probes binary")
    lost = packs.groupBy("copy").cogroup(arrays.groupBy("copy")) \
        .applyInArrow(answer, "owner long, check long, line int")
    return lost.groupBy("owner", "check").agg(F.collect_set("line").alias("dropped"))


def dedup_lines(docs: DataFrame, least_chars: int = 10, carry: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the carried columns), ``kept_text``, ``n_lines``, ``n_dropped``.

    ``docs`` needs ``doc_id`` (integer), ``text``.  Lines are what lies between
    line ends; NULL and empty texts are one empty line.  A line whose key has at
    least ``least_chars`` code points and is held by several ids stays only in
    the row with the smallest; inside that row all its repetitions stay.  Rows
    that share an id are one document here.  NULL ids are one document, after
    all others.  An empty table gives an empty result.
    """
    carry = docs.columns if carry is None else carry
    own = docs.select(F.struct(*[docs[c] for c in carry]).alias("row"), docs["text"].alias("text"),
                      F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("owner"),
                      F.xxhash64(docs["text"]).alias("check"))
    marked = own.join(lines_to_drop(own, least_chars), ["owner", "check"], "left").select("row", "text", "dropped")
    schema = f"row {marked.schema['row'].dataType.simpleString()}, kept_text string, n_lines long, n_dropped long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                kept, n, n_dropped = [], [], []
                for text, dropped in zip(bytes_of(part, "text"), part.column("dropped").to_pylist()):
                    lines = text.split(b"\n")
                    n.append(len(lines))
                    n_dropped.append(len(dropped or ()))
                    if dropped:
                        gone = set(dropped)
                        text = b"\n".join([line for i, line in enumerate(lines) if i not in gone])
                    kept.append(text)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()),
                     pa.array(n_dropped, pa.int64())], ["row", "kept_text", "n_lines", "n_dropped"])

    return marked.mapInArrow(cut, schema)


SQL = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM split),
firsts AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT k.*, f.first IS NOT NULL AND k.doc_id <> f.first AS dropped FROM keyed k LEFT JOIN firsts f USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (dropped))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
