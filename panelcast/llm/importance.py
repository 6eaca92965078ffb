"""Quality by importance resampling: a document's weight is the ratio of two hashed n-gram models.

The target model counts the hashed words and word pairs of good labelled texts,
the raw model those of all texts.  Both have a fixed number of buckets, so what
is collected and sent to the tasks has a fixed size.  A text's log weight is the
sum of the log ratios of its n-grams.  Adding Gumbel noise to the log weights
and keeping the k largest keys draws k documents without replacement, with
probabilities in proportion to their weights.  The k-th key is found by exact
counts of keys in ever finer intervals, never by sorting all keys in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import by_bytes, bytes_of, numbered
from panelcast.session import materialize

BUCKETS = 1 << 16
REMEMBERED_WORDS = 300_000
LABELLED_SAMPLE = 20_000


class NgramBuckets:
    """Buckets of a text's words and word pairs; remembers the hashes of words within a bound."""

    def __init__(self, buckets: int):
        self.buckets, self.known = np.uint64(buckets), {}

    def slice_of(self, texts: list[bytes]) -> list[np.ndarray]:
        split = [text.lower().split() for text in texts]
        words = set().union(*split)
        new = [w for w in words if w not in self.known]
        if len(self.known) > REMEMBERED_WORDS:
            self.known = {w: self.known[w] for w in words & self.known.keys()}
        self.known.update((w, xxhash.xxh64_intdigest(w)) for w in new)
        return [self._buckets(words) for words in split]

    def _buckets(self, words: list[bytes]) -> np.ndarray:
        single = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        with np.errstate(over="ignore"):
            pair = single[:-1] * np.uint64(0x9E3779B97F4A7C15) + single[1:]
            pair ^= pair >> np.uint64(32)
        return (np.concatenate([single, pair]) % self.buckets).astype(np.int64)


def ngram_models(docs: DataFrame, good_ids: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Log ratio per bucket of the target model (rows whose id is among the sorted ``good_ids``) to the raw model (all rows)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ngrams, totals = NgramBuckets(buckets), np.zeros((2, buckets), np.int64)
        for batch in batches:
            for part in by_bytes(batch, "text"):
                ids = part.column("id")
                good = np.isin(ids.fill_null(-1).to_numpy(), good_ids) & ids.is_valid().to_numpy(zero_copy_only=False)
                found = ngrams.slice_of(bytes_of(part, "text"))
                totals[0] += np.bincount(np.concatenate(found), minlength=buckets)
                target = [f for f, g in zip(found, good) if g]
                if target:
                    totals[1] += np.bincount(np.concatenate(target), minlength=buckets)
        used = np.flatnonzero(totals[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(t[used]) for t in totals]], ["bucket", "raw", "target"])

    rows = docs.select(docs["doc_id"].cast("long").alias("id"), "text") \
        .mapInArrow(count, "bucket long, raw long, target long") \
        .groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect()  # at most one row per bucket
    totals = np.zeros((2, buckets))
    for bucket, raw, target in rows:
        totals[:, bucket] = raw, target
    raw, target = totals + 1
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def keep_largest(scored: DataFrame, k: int) -> DataFrame:
    """Adds ``kept``: whether the row's ``key`` is among the k largest (ties: smaller ``id``, then ``spread``, if there)."""
    low, high = scored.agg(F.min("key"), F.max("key")).first()
    if low is None:
        return scored.withColumn("kept", F.lit(False))
    above, steps = 0, 1024
    # Invariant: ``above`` rows have a key over ``high``, and the k-th largest is in [low, high].
    while high > low:
        width = (high - low) / steps
        place = F.least(F.floor((F.col("key") - low) / width), F.lit(steps - 1))
        counts = dict(scored.filter(F.col("key").between(low, high)).groupBy(place.alias("p")).count().collect())
        if sum(counts.values()) <= 10_000:
            break
        sums = above
        for p in range(steps - 1, -1, -1):
            if sums + counts.get(p, 0) >= k:
                break
            sums += counts.get(p, 0)
        bounds = scored.filter(F.col("key").between(low, high) & (place == p)).agg(F.min("key"), F.max("key")).first()
        if bounds[0] is None or (bounds[0], bounds[1]) == (low, high):
            break
        above, (low, high) = sums, bounds
    inside = F.col("key").between(low, high)
    # Only the rows of the last interval are numbered: at most 10,000, or rows that share one key, dealt by their own numbers.
    order = [F.desc("key"), F.asc("id"), *([F.asc("spread")] if "spread" in scored.columns else [])]
    close = numbered(scored.filter(inside), *order)
    return scored.filter(~inside).withColumn("kept", F.col("key") > high).unionByName(
        close.withColumn("kept", F.col("place") < k - above).drop("place"))


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 4, buckets: int = BUCKETS,
             sample: int = LABELLED_SAMPLE, carry: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the carried columns), ``n_words``, ``log_weight``, ``key``, ``kept`` of every document.

    ``docs`` needs ``doc_id`` (integer), ``text``; ``labels`` needs ``doc_id,
    quality, toxic``.  The target model is fitted on at most ``sample`` good
    labelled ids, those with the smallest seeded hash; the raw model and the
    draw cover all documents.  ``share`` of the documents are drawn, by default
    the share of good ones among the labels.  NULL and empty texts weigh 1
    (log 0).  NULL labels are left out, an id with several labels is good only
    if all say so.  Rows that share an id share its noise.  Without labels the
    models are equal up to smoothing and all documents are kept; if no label is
    good, none is.
    """
    carry = docs.columns if carry is None else carry
    judged = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        ((F.min("quality") == 1) & (F.coalesce(F.max("toxic"), F.lit(0)) == 0)).alias("good"))
    good_ids = np.array(sorted(r[0] for r in judged.filter("good").orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id")
                               .limit(sample).select("doc_id").collect()), np.int64)
    if share is None:
        share = judged.agg(F.avg(F.col("good").cast("double"))).first()[0]
        share = 1.0 if share is None else share  # no labels at all: nothing speaks against any document
    ratio = ngram_models(docs, good_ids, buckets)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ngrams = NgramBuckets(buckets)
        for batch in batches:
            for part in by_bytes(batch, "text"):
                found = ngrams.slice_of(bytes_of(part, "text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array([(len(f) + 1) // 2 for f in found], pa.int64()),
                     pa.array([float(ratio[f].sum()) for f in found], pa.float64())], ["row", "n_words", "log_weight"])

    row = F.struct(F.struct(*[docs[c] for c in carry]).alias("row"), docs["doc_id"].cast("long").alias("id"))
    packed = docs.select(row.alias("row"), docs["text"].alias("text"))
    # 52 hashed bits, never 0 or 1
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("gumbel"), F.col("id")), 12) + F.lit(0.5)) / F.lit(2.0 ** 52)
    schema = packed.schema["row"].dataType.simpleString()
    scored = materialize(packed.mapInArrow(weigh, f"row {schema}, n_words long, log_weight double").select("row.*", "n_words", "log_weight")
                         .withColumn("key", F.col("log_weight") - F.log(-F.log(uniform)))
                         .withColumn("spread", F.monotonically_increasing_id()), "weighed")
    k = round(share * scored.count())
    return keep_largest(scored, k).drop("id", "spread")
