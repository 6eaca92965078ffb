"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

A source's target is its weight's share of the wanted total.  Targets above
``max_epochs`` times the source's size are clamped, and what they leave over is
shared out again by weight, until no target is above its cap.  A source then
takes every document ``floor(target / size)`` times; the fraction is filled by
documents in the order of a seeded hash, so that the taken words differ from the
target by half a document at most.

Only DataFrame functions are used.  Documents are dealt by source and hash
bucket, so a source with a third of all rows is spread over all tasks; the only
table that is ordered as a whole has one row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import word_count
from panelcast.session import materialize

BUCKET_BITS = 10


def source_key(source: Column) -> Column:
    """Total order and equality that include NULL, which comes last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def _hash(seed: int, row_id: Column) -> Column:
    """52 hashed bits of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def repeating_weights(sources: DataFrame, pattern=(5, 2, 1)) -> DataFrame:
    """Weights dealt to the sources in the order of their keys."""
    place = (F.row_number().over(Window.orderBy("key")) - 1) % len(pattern)
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in pattern]), place + 1))


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """Adds ``target`` to ``key, source_size, weight``.

    Each round is one aggregate over the sources: those whose share is above
    their cap are clamped, the level of the rest rises.  If all are clamped, the
    total is not reached and every target is its cap.  A source of weight 0 or
    NULL gets nothing.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    weight = F.coalesce(F.col("weight"), F.lit(0.0))
    clamped, seen = F.lit(False), -1
    while True:
        row = sources.agg(F.sum(F.when(clamped, cap)).alias("cap"), F.sum(F.when(~clamped, weight)).alias("weight"),
                          F.count(F.when(clamped, 1)).alias("n")).first()
        left = total - (row["cap"] or 0.0)
        level = left / row["weight"] if row["weight"] else 0.0
        if row["n"] == seen:
            break
        seen = row["n"]
        clamped = clamped | (weight * F.lit(level) > cap)
    return sources.withColumn("target", F.when(clamped, cap).otherwise(weight * F.lit(level)))


def mix(docs: DataFrame, weights=repeating_weights, share: float = 1.5, max_epochs: float = 2.0, seed: int = 20,
        carry: list[str] | None = None) -> DataFrame:
    """How often each document enters the mix.

    ``docs`` needs ``doc_id, text, source``.  ``weights`` maps one row per source
    (``key, source_size``) to the same with ``weight``.  Returns ``row`` (struct
    of the columns in ``carry``, by default all; so no name can clash),
    ``size, source_size, target, repeats``.

    NULL or empty texts have size 0 and are carried with the whole repetitions
    of their source; NULL sources form one source, NULL ids hash alike.  Repeated rows are documents
    of their own; rows alike in id and size are interchangeable.  An empty table
    gives an empty mix.
    """
    carry = docs.columns if carry is None else carry
    sized = docs.select(F.struct(*[docs[c] for c in carry]).alias("row"), source_key(docs["source"]).alias("key"),
                        word_count(docs["text"]).alias("size"), docs["doc_id"].alias("id"),
                        _hash(seed, docs["doc_id"]).alias("h")) \
        .withColumn("bucket", F.shiftright("h", 52 - BUCKET_BITS))
    buckets = materialize(sized.groupBy("key", "bucket").agg(F.sum("size").alias("bucket_size")), "mix-buckets")
    sizes = buckets.groupBy("key").agg(F.sum("bucket_size").alias("source_size"))
    sources = materialize(weights(sizes), "mix-sources")
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0) * share
    targets = water_fill(sources, total, max_epochs) \
        .withColumn("whole", F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))) \
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = buckets.withColumn("ahead", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0))) \
        .drop("bucket_size").join(targets.drop("weight"), "key")
    before = F.coalesce(F.sum("size").over(
        Window.partitionBy("key", "bucket").orderBy("h", "id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("ahead")
    extra = (F.col("rest") > 0) & (2 * F.col("before") + F.col("size") <= 2 * F.col("rest"))
    return sized.join(plan, ["key", "bucket"]).withColumn("before", before) \
        .select("row", "size", "source_size", "target",
                (F.col("whole") + F.when(extra, 1).otherwise(0)).cast("int").alias("repeats"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    mixed = mix(docs, **options).filter("repeats > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), "repeats"))).select("row.*")


SQL = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('20:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT AS h FROM documents),
sources AS (SELECT key, sum(size)::BIGINT AS source_size FROM sized GROUP BY key),
weighted AS (SELECT *, [5.0, 2.0, 1.0][1 + ((row_number() OVER (ORDER BY key) - 1) % 3)::INT]::DOUBLE AS weight,
                    source_size * 2.0::DOUBLE AS cap FROM sources),
levels AS (
  SELECT *, (((SELECT sum(source_size) FROM sources) * 1.5)::DOUBLE
    - coalesce(sum(cap) OVER (ORDER BY cap / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
marked AS (SELECT *, weight * level > cap AS clamped FROM levels),
final AS (
  SELECT (((SELECT sum(source_size) FROM sources) * 1.5)::DOUBLE - coalesce(sum(cap) FILTER (clamped), 0))
         / nullif(sum(weight) FILTER (NOT clamped), 0) AS level FROM marked),
targets AS (
  SELECT key, source_size, CASE WHEN clamped THEN cap ELSE weight * final.level END AS target FROM marked, final),
parts AS (
  SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS whole FROM targets),
ordered AS (
  SELECT s.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
         coalesce(sum(size) OVER (PARTITION BY key ORDER BY h, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN parts p USING (key))
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN rest > 0 AND 2 * before + size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
"""
