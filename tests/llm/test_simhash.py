import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from panelcast.llm import components, simhash


def brute_print(text, width=3):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, linked):
    root = {i: i for i in range(len(ids))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(ids))]


def variants(prose):
    rows = [(i, prose(30 + i % 50, i)) for i in range(60)]
    for i in range(60, 160):  # copies with a word changed
        base = rows[i % 12][1].split()
        base[i % len(base)] = f"new{i}"
        rows.append((i, " ".join(base)))
    long = prose(4000, 7)
    rows += [(900 - i, long + f" tail{i}") for i in range(40)] + [(i, prose(2, i)) for i in range(200, 210)]
    rows += [(300, None), (301, ""), (302, " \n"), (None, rows[3][1]), (None, "only null id here"), (5, rows[5][1]), (400, rows[4][1].upper())]
    return rows


@pytest.mark.parametrize("tile", [4096, 8])
def test_components_equal_brute_force(documents, prose, tile):
    rows = variants(prose)
    prints = [brute_print(t) for _, t in rows]
    want = brute_components([i for i, _ in rows], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    got = simhash.near_duplicates(documents(rows), tile=tile).collect()
    assert sorted(((r["row"]["doc_id"], int.from_bytes(r["print"], "big"), r["component"]) for r in got), key=repr) == \
        sorted(zip([i for i, _ in rows], prints, want), key=repr)
    assert len(set(want)) < len(rows) - 40
    assert simhash.near_duplicates(documents([])).count() == 0


def test_steps_reach_all_close_cells():
    rng = np.random.default_rng(3)
    steps = set(simhash.cell_steps(4, 2))
    for _ in range(500):
        a = int(rng.integers(0, 1 << 63))
        b = a ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64)))
        d = simhash.cell_of(b.to_bytes(8, "big"), 4) - simhash.cell_of(a.to_bytes(8, "big"), 4)
        assert d in steps or -d in steps


@pytest.mark.parametrize("tile", [4096, 8])
def test_stage_keeps_one_of_each_component(documents, prose, tile):
    rows = variants(prose) + [(5, prose(40, 5)), (None, "only null id here"), (None, "another null id")]
    prints = [brute_print(t) for _, t in rows]
    linked = lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2
    names = brute_components(list(range(len(rows))), linked)  # the first row of the component
    least = {}
    for name, (i, _) in zip(names, rows):
        least[name] = min(least.get(name, (True, 0)), (i is None, i or 0))
    docs = documents(rows)
    got = simhash.drop_near_duplicates(docs, tile=tile)
    assert got.columns == docs.columns
    seen = [(r["doc_id"] is None, r["doc_id"] or 0) for r in got.collect()]
    assert sorted(seen) == sorted(least.values())
    empty = documents([])
    assert simhash.drop_near_duplicates(empty).schema == empty.schema and simhash.drop_near_duplicates(empty).count() == 0


def test_stage_on_one_very_long_text_and_many_copies(documents, prose):
    long = prose(200_000, 1)
    rows = [(9, long), (8, long + " one more word"), (7, prose(50, 2))] + [(i, prose(12, 3)) for i in range(100, 5_100)]
    assert sorted(r["doc_id"] for r in simhash.drop_near_duplicates(documents(rows)).select("doc_id").collect()) == [7, 8, 100]


def test_connected_components(spark):
    rng = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, None), (7, 7)]
    nodes = sorted({x for a, b in links if b is not None and a != b for x in (a, b)})
    pairs = set(links) | {(b, a) for a, b in links}
    want = brute_components(nodes, lambda i, j: (nodes[i], nodes[j]) in pairs)
    got = {r["node"]: r["component"] for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == dict(zip(nodes, want))
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0
