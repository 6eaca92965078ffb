import hashlib
import math
import re
import zlib

import pytest

from panelcast.llm import target_resampling as tr


def features(text, longest):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return len(words), [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, longest, buckets, percent, least):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    raw, goal = [0] * buckets, [0] * buckets
    for _, text in rows:
        for f in features(text, longest)[1]:
            raw[bucket(f)] += 1
    for text in target:
        for f in features(text, longest)[1]:
            goal[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t + 1) * (sum(raw) + buckets) / ((s + 1) * (sum(goal) + buckets)))) for s, t in zip(raw, goal)]
    out = []
    for i, text in rows:
        n, found = features(text, longest)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = fit[:percent * len(fit) // 100]
    ranks = sorted((r[0], r[4], k + 1) for k, r in enumerate(drawn) if r[0] is not None)
    return sorted(map(tuple, out), key=repr), ranks, len(drawn)


def rows_of(prose):
    rows = [(i, prose(15 + i % 30, i).title() + ("! naïve-ÉTÉ 3.14" if i % 3 else "")) for i in range(120)]
    return rows + [(200, None), (201, ""), (202, "?!"), (203, "x" * 200_000), (204, prose(20_000, 3)), (7, rows[7][1]), (7, prose(40, 1)),
                   (None, prose(30, 2)), (None, prose(30, 2)), (205, prose(60, 4)), (206, prose(60, 4))]


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_equals_brute_force(spark, documents, prose, longest):
    rows, target = rows_of(prose), [prose(50, 77), None, "", "w1 w2 w3"]
    goal = spark.createDataFrame([(1, t, "q") for t in target], "item_id long, text string, row string")
    got = tr.resample_to_target(documents(rows).repartition(4), goal, longest, 500, 25, 20).collect()
    wanted, ranks, drawn = brute(rows, target, longest, 500, 25, 20)
    assert sorted(((r["row"]["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"]) for r in got), key=repr) == wanted
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, drawn + 1))
    assert sorted((r["row"]["doc_id"], r["score"], r["rank"]) for r in got if r["rank"] and r["row"]["doc_id"] is not None) == ranks


def test_head_only_saves_time(documents, prose):
    docs = documents(rows_of(prose))
    full, none = tr.head(docs, 2), ([], [])
    assert full[0] and full[1] and all(len(w) <= tr.HEAD_BYTES for w in full[0] + full[1])
    assert (tr.bucket_totals(docs, full, 2, 300) == tr.bucket_totals(docs, none, 2, 300)).all()


def test_empty_and_ties(spark, documents):
    goal = spark.createDataFrame([], "text string")
    assert tr.resample_to_target(documents([]), goal).count() == 0
    text = " ".join(["same"] * 25)
    got = tr.resample_to_target(documents([(5, text)] * 40 + [(None, text)] * 20), goal, percent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 31)) and len(got) == 60
