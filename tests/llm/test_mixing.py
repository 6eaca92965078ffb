from panelcast.llm import mixing


def by_source(df):
    out = {}
    for r in df.collect():
        s = out.setdefault(r["row"]["source"], {"target": r["target"], "size": r["source_size"], "taken": 0})
        s["taken"] += r["size"] * r["repeats"]
        assert 0 <= r["repeats"] <= 2
    return out


def test_targets_are_water_filled(documents, prose):
    sizes = {"a": 10, "b": 400, "c": 900, None: 200}
    docs = documents([(100 * i + j, prose(n // 10, i * 100 + j), "en", s)
                      for i, (s, n) in enumerate(sizes.items()) for j in range(10)])
    got = by_source(mixing.mix(docs))
    assert {s: x["size"] for s, x in got.items()} == sizes
    # brute force: weights 5, 2, 1, 5 with NULL last
    weights, caps = dict(zip(sizes, (5, 2, 1, 5))), {s: 2 * n for s, n in sizes.items()}
    total, clamped = 1.5 * sum(sizes.values()), set()
    while True:
        level = (total - sum(caps[s] for s in clamped)) / sum(w for s, w in weights.items() if s not in clamped)
        over = {s for s, w in weights.items() if s not in clamped and w * level > caps[s]}
        if not over:
            break
        clamped |= over
    for s, x in got.items():
        assert abs(x["target"] - (caps[s] if s in clamped else weights[s] * level)) < 1e-9
        assert abs(x["taken"] - x["target"]) <= sizes[s] / 20


def test_rows_repeat_and_reruns_agree(documents, prose):
    docs = documents([(i, prose(5 + i % 7, i), "en", f"s{i % 3}") for i in range(60)])
    first = sorted(mixing.mixed_rows(docs).collect())
    assert first == sorted(mixing.mixed_rows(docs.repartition(5)).collect())
    assert set(first[0].asDict()) == set(docs.columns)
    taken = {(r["row"]["doc_id"]): r["repeats"] for r in mixing.mix(docs).collect()}
    assert len(first) == sum(taken.values())


def test_edges(documents, spark):
    assert mixing.mix(documents([])).count() == 0
    odd = documents([(None, None, None, None), (None, None, None, None), (1, "", "en", "a"), (1, " \t\n", "en", "a"), (2, "x y", None, "a")])
    rows = mixing.mix(odd).collect()
    assert len(rows) == 5 and sum(r["size"] for r in rows) == 2
    assert all(r["target"] == 0 for r in rows if r["row"]["source"] is None)


def test_main_path_is_native(documents):
    plan = mixing.mix(documents([(1, "a b", "en", "s")]).select("doc_id", "text", "source"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
