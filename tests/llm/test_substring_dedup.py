import random

import numpy as np

from panelcast.llm import substring_dedup


def brute(rows, width):
    order = lambda i: (i is None, i or 0)
    split = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, ws in split:
        for k in range(len(ws) - width + 1):
            key = tuple(ws[k:k + width])
            first[key] = min(first.get(key, (True, 1 << 62)), order(i))
    out = []
    for i, ws in split:
        gone = set()
        for k in range(len(ws) - width + 1):
            if first[tuple(ws[k:k + width])] < order(i):
                gone.update(range(k, k + width))
        out.append((i, b" ".join(w for k, w in enumerate(ws) if k not in gone).decode(), len(ws), len(gone)))
    return sorted(out, key=repr)


def seen(result):
    return sorted(((r["row"]["doc_id"], r["kept_text"], r["n_words"], r["n_removed"]) for r in result), key=repr)


def rows_of(prose):
    passage = [prose(70, 900 + k) for k in range(6)]
    rows = [(i, f"{prose(30, i)} {passage[i % 6]}  \n{prose(20, 5000 + i)}\t{passage[(i * 5) % 6]}") for i in range(60)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (3, rows[3][1]), (3, rows[4][1]), (102, None), (103, ""), (104, "x"), (105, prose(49, 1))]
    rows += [(106, prose(50, 7)), (107, prose(50, 7)), (108, "é " * 200), (109, "é " * 120), (None, passage[0]), (None, passage[0] + " tail"),
             (110, prose(60, 8, 3)), (111, prose(400, 9, 2)), (112, prose(400, 9, 2).upper()), (-5, passage[1])]
    return rows


def test_equals_brute_force(documents, prose):
    rows = rows_of(prose)
    docs = documents(rows).repartition(5)
    assert seen(substring_dedup.dedup_substrings(docs).collect()) == brute(rows, 50)
    assert seen(substring_dedup.dedup_substrings(docs, 3).collect()) == brute(rows, 3)
    assert seen(substring_dedup.dedup_substrings(docs, 1).collect()) == brute(rows, 1)
    assert substring_dedup.dedup_substrings(documents([])).count() == 0


def test_long_texts_are_hashed_in_parts(documents, prose, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SEGMENT_WORDS", 64)
    rows = rows_of(prose) + [(200, prose(3000, 11)), (201, "head " + " ".join(prose(3000, 11).split()[500:2500]) + " tail")]
    got = []
    hashes = substring_dedup.WordHashes()
    for i, text in rows[-2:]:
        words = text.encode().split()
        got += [(i, 0, begin, words[begin:begin + 64 + 49]) for begin in range(0, len(words) - 49, 64)]
    runs, least, sent, known = substring_dedup.slice_windows(got, 50, hashes)
    spans = substring_dedup.merged([(k["start"], k["stop"]) for k in known if k["owner"] == 201])
    assert spans == [[1, 2001]] and runs["count"].sum() == len(sent) and len(least) == len(runs)


def test_spans_and_pre_aggregation(documents, prose):
    """A passage that all documents hold is sent once per slice, and spans are maximal."""
    hot = prose(80, 3).encode().split()
    parts = [(i, 0, 0, hot) for i in range(1, 500)]
    runs, _, sent, known = substring_dedup.slice_windows(parts, 50, substring_dedup.WordHashes())
    assert len(sent) == 31 and set(runs["owner"]) == {1} and len(known) == 498
    rows = [(1, " ".join(["a"] + [w.decode() for w in hot])), (2, prose(10, 5) + " " + " ".join(w.decode() for w in hot) + " end")]
    spans = {r["row"]["doc_id"]: r["spans"] for r in substring_dedup.dedup_substrings(documents(rows)).collect()}
    assert spans == {1: [], 2: [[10, 90]]}


def test_sliding_minimum():
    rng = random.Random(1)
    x = np.array([rng.getrandbits(64) for _ in range(200)], np.uint64)
    for size in (1, 2, 3, 47, 64, 200):
        assert (substring_dedup.sliding_min(x, size) == [x[i:i + size].min() for i in range(len(x) - size + 1)]).all()
