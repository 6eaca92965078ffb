"""Quality rules whose cutoffs carry a guarantee.

A document's statistics are taken from its whole text.  Fixed base rules reject
fragments and texts that repeat themselves.  Further rules compare a statistic
with a cutoff, and the cutoffs are chosen on labelled documents.  They form one
chain from lax to strict, each step with one more cutoff of one rule.  For every
stratum and step, the good documents that all rules together would reject are
counted, and the step is certified if the exact (Clopper-Pearson) upper bound of
its false rejection rate is within the allowed risk.  The steps are tested in
their order up to the first failure, so a stratum's error level need not be
divided among them; it is divided by the number of strata (Bonferroni).  The
strictest certified step is used.  A stratum with too few labelled good documents
certifies none, and then rejects nothing beyond the base rules.

The candidate cutoffs are fixed beforehand, so every labelled row is holdout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import by_bytes, bytes_of
from panelcast.session import materialize

SYMBOLS = b"#*$%&|<>"
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"

# Rule: numerator and denominator of its statistic, cutoffs from strict to lax.
# A document is rejected if its statistic is above the cutoff.
RULES = {
    "symbols": ("n_symbols", "n_words", (0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3, 0.5, 1.0)),
    "dup_lines": ("n_dup_lines", "n_words", (0.002, 0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12)),
    "repeats": ("n_repeat_words", "n_words", (0.02, 0.04, 0.06, 0.1, 0.15, 0.2, 0.3, 0.4)),
    "long_words": ("word_chars", "n_words", (5.5, 6.0, 6.5, 7.0, 8.0, 9.0, 11.0, 14.0)),
    "short_words": ("n_words", "word_chars", (0.16, 0.18, 0.2, 0.22, 0.25, 0.3, 0.4, 0.5)),
}


def _repeated_words(words: list[bytes]) -> int:
    """Positions inside three-word windows that occur at least twice."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    k = len(seen)
    if k == n:
        return 0
    pair = ids[:-1] * k + ids[1:]
    if k > 1_000_000:  # the triple would not fit 64 bits: number the pairs first
        pair = np.unique(pair, return_inverse=True)[1]
    _, where, times = np.unique(pair[:-1] * k + ids[2:], return_inverse=True, return_counts=True)
    repeated = times[where] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= repeated
    return int(covered.sum())


def text_counts(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()
    inside = b"".join(words)
    chars = len(inside) if inside.isascii() else len(inside.decode())
    lines = [line for line in text.split(b"\n") if line.split(None, 1)] if b"\n" in text else []
    return (len(words), chars, sum(inside.count(bytes([s])) for s in SYMBOLS), len(lines) - len(set(lines)),
            _repeated_words(words))


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in COUNTS.split(", ")]
    for batch in batches:
        for part in by_bytes(batch, "text"):
            rows = np.array([text_counts(t) for t in bytes_of(part, "text")], np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([part.column("row"), *[pa.array(rows[:, i]) for i in range(5)]],
                                             ["row", *names])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def measure(docs: DataFrame, carry: list[str] | None = None, stratum: str = "lang") -> DataFrame:
    """Statistics per document beside ``row``, a struct of the carried columns, the id and the stratum."""
    carry = docs.columns if carry is None else carry
    row = F.struct(F.struct(*[docs[c] for c in carry]).alias("given"), docs["doc_id"].alias("id"),
                   F.coalesce(docs[stratum].cast("string"), F.lit("")).alias("stratum"))
    packed = docs.select(row.alias("row"), docs["text"].alias("text"))
    schema = packed.schema["row"].dataType.simpleString()
    counted = packed.mapInArrow(_count_batches, f"row {schema}, {COUNTS}")
    return counted.select("row.*", *[p.split()[0] for p in COUNTS.split(", ")])


def upper_tail_ok(rejected: int, total: int, risk: float, level: float) -> bool:
    """Whether the exact upper bound for ``rejected`` of ``total`` is within ``risk`` at ``level``.

    The bound is below ``risk`` exactly if so few rejections have a probability
    of at most ``level`` under a true rate of ``risk``.
    """
    if rejected >= total * risk:
        return False
    log_p, log_q = math.log(risk), math.log1p(-risk)
    terms = [math.lgamma(total + 1) - math.lgamma(i + 1) - math.lgamma(total - i + 1) + i * log_p + (total - i) * log_q
             for i in range(rejected + 1)]
    return math.fsum(map(math.exp, terms)) <= level


def chain(rules) -> list[tuple[str, float]]:
    """All cutoffs as ``(rule, cutoff)`` from lax to strict, the rules in turns by the share of their cutoffs used."""
    steps = [((i + 1) / len(cutoffs), name, float(c)) for name, (_, _, cutoffs) in rules.items()
             for i, c in enumerate(sorted(cutoffs, reverse=True))]
    return [(name, c) for _, name, c in sorted(steps, key=lambda step: step[0])]


def certify(labelled: DataFrame, rules=None, risk: float = 0.02, level: float = 0.05) -> DataFrame:
    """Counts, verdict and cutoffs for ``labelled`` (statistics, ``stratum``, ``good``).

    Returns ``stratum, rule, cutoff, n_good, n_rejected, certified``, one row for
    each step of the chain; ``n_rejected`` counts what this cutoff and those before it reject.
    ``risk`` is the largest share of a stratum's good documents that all rules together
    may reject, ``level`` the probability that this fails in any stratum.
    """
    rules = RULES if rules is None else rules
    steps = chain(rules)
    # A document is rejected from the first step on that rejects it.
    first = F.coalesce(*[F.when(above(rules[name], c), F.lit(k)) for k, (name, c) in enumerate(steps)], F.lit(len(steps)))
    counted = labelled.filter("good").withColumn("first", first).groupBy("stratum").agg(
        F.count("*").alias("n_good"),
        F.array(*[F.count(F.when(F.col("first") <= k, 1)) for k in range(len(steps))]).alias("rejected"))
    each = level / max(1, counted.count())

    @F.pandas_udf("boolean")
    def within(rejected, total):
        import pandas as pd
        # Counts never fall along the chain, so no step after a failure passes.
        return pd.Series([upper_tail_ok(int(k), int(n), risk, each) for k, n in zip(rejected, total)], dtype="bool")

    numbered = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(c).alias("cutoff")) for name, c in steps])
    return counted.select("stratum", "n_good", F.explode(F.arrays_zip(numbered.alias("g"), F.col("rejected"))).alias("x")) \
        .select("stratum", "x.g.rule", "x.g.cutoff", "n_good", F.col("x.rejected").alias("n_rejected")) \
        .withColumn("certified", within("n_rejected", "n_good"))


def above(rule, cutoff) -> Column:
    top, bottom, _ = rule
    return F.col(top) > F.col(bottom) * cutoff


def apply_rules(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None, rules=None, risk: float = 0.02,
                level: float = 0.05) -> DataFrame:
    """Every document with its statistics, ``base_failed`` and ``kept``.

    ``docs`` needs ``doc_id, text, lang``; ``labels`` needs ``doc_id, quality``.
    Returns ``row`` (struct of the carried columns), the five counts,
    ``base_failed``, ``kept``, ``failed_rules`` (array).  NULL and empty texts
    have counts 0 and fail the base rules.  A NULL language is a stratum of its
    own.  Labels that are NULL are left out; an id with several labels is good
    only if all say so; rows that share an id share its label.  Labelled rows
    that fail the base rules do not count.  Without labels nothing is rejected
    beyond the base rules; an empty table gives an empty result.
    """
    rules = RULES if rules is None else rules
    stats = measure(docs, carry).withColumn("base_failed", base_failed())
    if carry is not None and "text" not in carry:
        stats = materialize(stats, "quality-counts")
        light = stats
    else:
        light = measure(docs, []).withColumn("base_failed", base_failed())
    judged = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("id")) \
        .agg((F.min("quality") == 1).alias("good"))
    labelled = light.filter("NOT base_failed").drop("given").join(judged, "id")
    bounds = materialize(certify(labelled, rules, risk, level), "quality-bounds")
    chosen = bounds.filter("certified").groupBy("stratum").agg(
        *[F.min(F.when(F.col("rule") == name, F.col("cutoff"))).alias(f"cut_{name}") for name in rules])
    failed = F.array_compact(F.array(*[F.when(above(rules[name], F.col(f"cut_{name}")), F.lit(name)) for name in rules]))
    return stats.join(chosen, "stratum", "left").withColumn("failed_rules", failed).select(
        F.col("given").alias("row"), *[p.split()[0] for p in COUNTS.split(", ")], "base_failed",
        (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"), "failed_rules")
