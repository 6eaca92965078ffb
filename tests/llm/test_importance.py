import math

from pyspark.sql import functions as F

from panelcast.llm import importance


def corpus(documents, prose):
    good = [(i, prose(60, i, 300)) for i in range(150)]
    bad = [(i, " ".join(f"junk{(i * j) % 50}" for j in range(60))) for i in range(150, 200)]
    return documents(good + bad)


def test_good_texts_are_drawn(documents, prose, spark):
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(0, 200, 2)], "doc_id long, quality int, toxic int")
    rows = importance.resample(corpus(documents, prose), labels).collect()
    assert len(rows) == 200 and sum(r["kept"] for r in rows) == 150
    # held out: odd ids were not labelled
    assert sum(r["kept"] for r in rows if r["row"]["doc_id"] % 2 and r["row"]["doc_id"] < 150) >= 74


def test_weights_are_the_ratio_of_the_models(documents, spark):
    docs = documents([(1, "a b a"), (2, "b c"), (3, None), (3, ""), (None, "c")])
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0), (2, None, 1)], "doc_id long, quality int, toxic int")
    rows = importance.resample(docs, labels, buckets=1 << 12, share=0.4).collect()
    n = 1 << 12
    grams = lambda t: t.split() + list(zip(t.split(), t.split()[1:]))
    raw, target = [grams(t) for t in ("a b a", "b c", "c")], grams("a b a")
    every = [g for x in raw for g in x]
    ratio = lambda g: math.log((target.count(g) + 1) / (len(target) + n)) - math.log((every.count(g) + 1) / (len(every) + n))
    for r in rows:
        text = r["row"]["text"] or ""
        assert abs(r["log_weight"] - sum(map(ratio, grams(text)))) < 1e-9 and r["n_words"] == len(text.split())
    assert sum(r["kept"] for r in rows) == 2
    assert importance.resample(documents([]), labels).count() == 0


def test_largest_keys_are_kept(spark):
    keyed = spark.range(30_000).select("id", (F.col("id") * 7919 % 30_011).cast("double").alias("key"))
    for k in (0, 1, 12_345, 30_000):
        kept = {r["key"] for r in importance.keep_largest(keyed, k).filter("kept").collect()}
        assert kept == set(sorted((float(i * 7919 % 30_011) for i in range(30_000)), reverse=True)[:k])
    tied = spark.range(20_000).select("id", F.lit(1.0).alias("key"))
    assert [r["id"] for r in importance.keep_largest(tied, 3).filter("kept").orderBy("id").collect()] == [0, 1, 2]


def test_bad_labels_keep_nothing_and_no_labels_keep_all(documents, prose, spark):
    docs = documents([(i, prose(20, i)) for i in range(20)] + [(None, "same text")] * 30)
    bad = spark.createDataFrame([(i, 0, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    assert importance.resample(docs, bad).filter("kept").count() == 0
    assert importance.resample(docs, bad.limit(0)).filter("kept").count() == 50
    # Rows alike in key and id are told apart by their own numbers: the share is met exactly.
    assert importance.resample(docs, bad, share=0.5).filter("kept").count() == 25
