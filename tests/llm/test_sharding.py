import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from panelcast.llm import sharding


def check(rows, got, shards):
    assert Counter(r["row"]["doc_id"] for r in got) == Counter(i for i, _ in rows)
    slots, sizes = {}, Counter({s: 0 for s in range(shards)})
    for r in got:
        text = (r["row"]["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 8, zlib.crc32(text))
        slots.setdefault(r["shard"], []).append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    mean = sum(sizes.values()) / shards
    assert all(abs(x - mean) <= 0.02 * mean + max(r["size"] for r in got) for x in sizes.values())
    return slots


def test_shards_are_even_and_copies_stay_together(documents, prose):
    rows = [(i, prose(5 + i % 60, i)) for i in range(1500)] + [(2000 + i, "the same text again " * 3) for i in range(20)]
    rows += [(None, None), (3000, ""), (3000, "")]
    got = sharding.shard(documents(rows).repartition(4), shards=8).collect()
    check(rows, got, 8)
    assert len({r["shard"] for r in got if (r["row"]["text"] or "").startswith("the same")}) == 1
    again = sharding.shard(documents(rows), shards=8).collect()
    key = lambda r: (repr(r["row"]), r["shard"], r["slot"])
    assert sorted(map(key, got))[:1400] == sorted(map(key, again))[:1400]


def test_a_group_larger_than_a_shard_is_split(documents, prose):
    rows = [(i, "one very large group of copies") for i in range(700)] + [(1000 + i, prose(6, i)) for i in range(300)]
    got = sharding.shard(documents(rows), shards=8).collect()
    assert len(check(rows, got, 8)) == 8


def test_small_tables(documents):
    assert sharding.shard(documents([])).count() == 0
    got = sharding.shard(documents([(1, "a"), (2, "b")]), shards=24).collect()
    assert len(got) == 2 and all(r["slot"] == 0 or r["shard"] == got[0]["shard"] for r in got)


def test_ranges_keep_slots_gapless(documents, prose, monkeypatch):
    rows = [(i, prose(4, i)) for i in range(900)]
    real = sharding.splitters
    monkeypatch.setattr(sharding, "splitters", lambda k, s, t: real(k, s, t, rows_per_range=20))
    check(rows, sharding.shard(documents(rows), shards=4).collect(), 4)


def keyed(docs):
    return docs.select(sharding.sort_key(docs["text"], docs["doc_id"]).alias("key"),
                       (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"))


def test_a_third_of_the_rows_with_one_text_fills_no_single_range(spark):
    n = 24_000
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("text "), "id")).alias("text"))
    table = keyed(rows)
    starts, shards, first = sharding.splitters(table, 8, rows_per_range=500)
    keys = np.sort(np.array([r.key for r in table.collect()]))
    edges = np.searchsorted(keys, starts)
    counts = np.diff(np.r_[edges, n])
    assert counts.max() <= 1000 and len(starts) <= 3 * n // 500
    shard_first = {s: edges[np.flatnonzero(shards == s)[0]] for s in set(shards.tolist())}
    assert first.tolist() == [e - shard_first[s] for e, s in zip(edges.tolist(), shards.tolist())]


def test_rows_alike_in_text_and_id_end_the_refining(spark):
    rows = spark.range(2_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    starts, shards, _ = sharding.splitters(keyed(rows), 4, rows_per_range=100)
    assert len(starts) == len(shards)
    got = sharding.shard(rows, shards=4).collect()
    assert sorted(r["slot"] for r in got) == list(range(2_000)) and len({r["shard"] for r in got}) == 1


def test_shards_are_slices_of_the_sorted_rows(documents, prose):
    """Brute force: the rows in order of key, cut at the shards' sizes."""
    rows = [(i, prose(3 + i % 40, i % 500)) for i in range(1200)] + [(5000 + i, None) for i in range(400)]
    docs = documents(rows)
    key = {r["doc_id"]: r["key"] for r in docs.select("doc_id", sharding.sort_key(docs["text"], docs["doc_id"]).alias("key")).collect()}
    got = {r["row"]["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard(docs, shards=6).collect()}
    order = sorted(key, key=lambda i: (key[i], str(i)))
    shards = [got[i][0] for i in order]
    assert shards == sorted(shards)
    assert [got[i][1] for i in order] == [j - shards.index(s) for j, s in enumerate(shards)]


def test_registered_query_keeps_its_contract(spark, tmp_path, documents, prose):
    from panelcast.llm.queries import op7_shard
    rows = [(i, prose(20, i % 150)) for i in range(300)] + [(1000, None), (1001, "")]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = op7_shard(spark, str(tmp_path))
    assert {f.name: f.dataType.simpleString() for f in got.schema} == {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}
    got = got.collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows) and {r.law for r in got} == {"bytes"}
    assert {r.shard for r in got} <= set(range(24)) and {r.grown_shard for r in got} == {None}
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
