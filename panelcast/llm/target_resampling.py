"""Importance resampling towards a target text: exact bucket totals with a head and a tail vocabulary.

Features are runs of up to ``longest`` consecutive words, each in the bucket its
CRC-32 gives.  Words are counted over all documents; the most frequent ones are
the head, whose CRC states go to all tasks: a word of the head costs one lookup,
and the checksum of a longer run continues the state of its first word.  Frequent
pairs go along with their own states.  The head has a fixed number of entries of
bounded length, so what is sent has a bound.  Every other feature, the tail, takes
its CRC directly and is not remembered.  Head and tail feed the same exact totals
per bucket, so the head decides about speed only.

A document's weight is the sum of its features' gains; weight plus Gumbel noise
of the id is its score.  Scores are ranked by one exchange by range, rows of equal
scores spread by a number of their own.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import by_bytes, bytes_of, numbered
from panelcast.session import materialize

BUCKETS = 10_000
HEAD_WORDS, HEAD_PAIRS, HEAD_BYTES = 50_000, 50_000, 64  # entries, and bytes of an entry: at most 6.4 MB
COUNTED = 400_000  # features that a task counts before it passes them on
# Digits, letters (upper case lowered) and all that is not ASCII are kept, the rest parts words.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


class States(dict):
    """CRC states of the head; other features are computed each time."""

    def __missing__(self, feature: bytes) -> int:
        return zlib.crc32(feature)


class Features:
    """Buckets of a text's runs of up to ``longest`` words."""

    def __init__(self, words: list[bytes], pairs: list[bytes], longest: int, buckets: int):
        self.longest, self.buckets = longest, np.uint32(buckets)
        self.words = States(zip(words, map(zlib.crc32, words)))
        self.pairs = dict(zip(pairs, map(zlib.crc32, pairs)))

    def _pairs(self, words: list[bytes], states: list[int]) -> list[int]:
        spaced = list(map(add, repeat(b" "), words[1:]))
        found = map(self.pairs.get, map(add, words, spaced))
        return [zlib.crc32(b, a) if known is None else known for a, b, known in zip(states, spaced, found)]

    def of(self, words: list[bytes]) -> np.ndarray:
        last = list(map(self.words.__getitem__, words))
        runs = [last]
        for length in range(2, self.longest + 1):
            last = self._pairs(words, last) if length == 2 else list(
                map(zlib.crc32, map(add, repeat(b" "), words[length - 1:]), last))
            runs.append(last)
        states = np.fromiter((s for run in runs for s in run), np.uint32, sum(map(len, runs)))
        return (states % self.buckets).astype(np.int64)


def head(docs: DataFrame, longest: int = 1, n_words: int = HEAD_WORDS, n_pairs: int = HEAD_PAIRS) -> tuple[list[bytes], list[bytes]]:
    """The most frequent words and pairs of all documents, by exact counts: the highest classes of counts that fit whole."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [Counter(), Counter()]

        def flush() -> Iterator[pa.RecordBatch]:
            for kind, counts in enumerate(seen):
                kept = [f for f in counts if len(f) <= HEAD_BYTES]
                if kept:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(kept, pa.binary()), pa.array([kind] * len(kept), pa.int32()),
                         pa.array([counts[f] for f in kept], pa.int64())], ["feature", "kind", "n"])
                counts.clear()

        for batch in batches:
            for part in by_bytes(batch, "text"):
                for text in bytes_of(part, "text"):
                    words = words_of(text)
                    seen[0].update(words)
                    if longest > 1:
                        seen[1].update(map(b" ".join, zip(words, words[1:])))
                if len(seen[0]) + len(seen[1]) > COUNTED:
                    yield from flush()
        yield from flush()

    # Words met once are no head; the rest is read twice.
    counts = materialize(docs.select("text").mapInArrow(count, "feature binary, kind int, n long")
                         .groupBy("kind", "feature").agg(F.sum("n").alias("n")).filter("n > 1"), "features")
    order = F.floor(F.log2("n") * 8).cast("int")
    classes = counts.groupBy("kind", order.alias("class")).count().collect()  # at most 8 * 63 for each kind

    def top(kind: int, limit: int) -> list[bytes]:
        least, room = None, limit
        for _, name, n in sorted((c for c in classes if c[0] == kind), key=lambda c: -c[1]):
            room -= n
            if room < 0:
                break
            least = name
        if least is None:
            return []
        fits = counts.filter((F.col("kind") == kind) & (order >= least))
        return [bytes(r[0]) for r in fits.select("feature").collect()]  # at most ``limit``

    return top(0, n_words), top(1, n_pairs) if longest > 1 else []


def bucket_totals(docs: DataFrame, vocabulary: tuple[list[bytes], list[bytes]], longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Exact number of features per bucket over all rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, totals = Features(*vocabulary, longest, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in by_bytes(batch, "text"):
                for text in bytes_of(part, "text"):
                    totals += np.bincount(features.of(words_of(text)), minlength=buckets)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], ["bucket", "n"])

    totals = np.zeros(buckets, np.int64)
    for bucket, n in docs.select("text").mapInArrow(count, "bucket long, n long") \
            .groupBy("bucket").agg(F.sum("n")).collect():  # at most one row per bucket
        totals[bucket] = n
    return totals


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the two smoothed bucket models, rounded down."""
    room = len(raw)
    above, below = float(raw.sum() + room), float(target.sum() + room)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * above / ((float(s) + 1) * below)))
                     for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def resample_to_target(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, percent: int = 10,
                       least_words: int = 20, seed: int = 2024, carry: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the carried columns), ``n_words``, ``n_features``, ``weight``, ``score``, ``rank`` of every document.

    ``docs`` needs ``doc_id, text``, ``target`` needs ``text``.  ``percent`` of
    the documents with at least ``least_words`` words are drawn, those with the
    highest scores; ties go to the smaller id.  ``rank`` counts the drawn from 1
    and is NULL for others.  NULL and empty texts have no features and weigh 0.
    Rows that share an id share its noise; rows alike in score and id share their
    ranks in any order.  A NULL id takes the noise of the empty string and comes
    last among ties.  Without target texts all gains come from smoothing alone.
    An empty table gives an empty result.
    """
    carry = docs.columns if carry is None else carry
    vocabulary = head(docs, longest)
    gains = bucket_gains(bucket_totals(docs, vocabulary, longest, buckets), bucket_totals(target, vocabulary, longest, buckets))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(*vocabulary, longest, buckets)
        for batch in batches:
            for part in by_bytes(batch, "text"):
                n_words, n_features, weight = [], [], []
                for text in bytes_of(part, "text"):
                    words = words_of(text)
                    found = features.of(words)
                    n_words.append(len(words))
                    n_features.append(len(found))
                    weight.append(int(gains[found].sum()))
                yield pa.RecordBatch.from_arrays([part.column("given"), *[pa.array(x, pa.int64()) for x in (n_words, n_features, weight)]],
                                                 ["given", "n_words", "n_features", "weight"])

    given = F.struct(F.struct(*[docs[c] for c in carry]).alias("row"), docs["doc_id"].alias("id"))
    packed = docs.select(given.alias("given"), docs["text"].alias("text"))
    schema = f"given {packed.schema['given'].dataType.simpleString()}, n_words long, n_features long, weight long"
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("given.id").cast("string"), F.lit("")))
    uniform = (F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    scored = materialize(packed.mapInArrow(weigh, schema).select(
        "given.row", "given.id", "n_words", "n_features", "weight",
        (F.col("weight") + F.floor(-1000 * F.log(-F.log(uniform)))).alias("score"),
        F.monotonically_increasing_id().alias("spread")), "scored")
    fits = F.col("n_words") >= least_words
    drawn = percent * scored.filter(fits).count() // 100
    ranked = numbered(scored.filter(fits), F.desc("score"), F.asc_nulls_last("id"), F.asc("spread"))
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    columns = ["row", "n_words", "n_features", "weight", "score"]
    return ranked.select(*columns, rank.alias("rank")).unionByName(
        scored.filter(~fits).select(*columns, F.lit(None).cast("long").alias("rank")))


SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[0-9a-z\x{80}-\x{10FFFF}]+') AS words, false AS target FROM documents
  UNION ALL
  SELECT NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[0-9a-z\x{80}-\x{10FFFF}]+'), true FROM benchmark),
counts AS (
  SELECT word, count(*) FILTER (NOT target) AS s, count(*) FILTER (target) AS t
  FROM (SELECT unnest(words) AS word, target FROM split) GROUP BY word),
-- CRC-32 a byte and eight shifts at a time; -1 marks a shift
steps AS (
  SELECT word, s, t, hex(encode(word)) AS h FROM counts),
hashed AS (
  SELECT word, s, t, xor(list_reduce(flatten(list_transform(range(0, len(h) // 2),
           lambda i: [('0x' || substr(h, 2 * i + 1, 2))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
           lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
           4294967295::BIGINT), 4294967295::BIGINT) % 10000 AS bucket FROM steps),
totals AS (SELECT bucket, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM hashed GROUP BY bucket),
sums AS (SELECT sum(s) AS s, sum(t) AS t FROM totals),
gains AS (
  SELECT bucket, floor(1000 * ln((b.t + 1) * (a.s + 10000) / ((b.s + 1) * (a.t + 10000))))::BIGINT AS gain
  FROM totals b, sums a),
weights AS (
  SELECT doc_id, sum(gain) AS weight
  FROM (SELECT doc_id, unnest(words) AS word FROM split WHERE NOT target) JOIN hashed USING (word) JOIN gains USING (bucket)
  GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                     / 4294967296))))::BIGINT AS score
  FROM split LEFT JOIN weights USING (doc_id) WHERE NOT target),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, (CASE WHEN rank <= n * 10 // 100 THEN rank END)::BIGINT AS rank
FROM scored s LEFT JOIN drawn USING (doc_id)
"""
