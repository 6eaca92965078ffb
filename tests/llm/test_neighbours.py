import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import neighbours


def brute(rows, k):
    usable = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    out = {}
    for q in usable:
        if q % 20 == 0:
            found = []
            for i, v in usable.items():
                if i != q:
                    score = 0.0
                    for a, b in zip(usable[q], v):
                        score += a * b
                    found.append((-score, i))
            out[q] = sorted(found)[:k]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, [2]) for i, v in rows], "vec_id long, embedding array<float>, query int, cells array<int>")


def test_recall_on_clustered_vectors(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + 0.3 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(3000)]
    want = brute(rows, 20)
    got = neighbours.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, tile=256).collect()
    assert len(got) == 20 * len(want)
    hits = 0
    for r in got:
        assert r["score"] == pytest.approx(sum(a * b for a, b in zip(rows[r["query_id"]][1], rows[r["vec_id"]][1])), abs=1e-12)
        hits += r["vec_id"] in {i for _, i in want[r["query_id"]]}
    assert hits >= 0.9 * len(got)


def test_small_table_is_exact_with_ties_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100 + i, rows[40][1]) for i in range(30)]
    rows += [(200, None), (220, [0.0] * 4), (240, [1.0, None, 0.0, 0.0]), (260, [float("nan"), 1.0, 1.0, 1.0]), (280, [float("inf"), 0.0, 0.0, 0.0]),
             (300, [1.0]), (None, rows[1][1]), (320, [])]
    want = brute([r for r in rows if r[0] != 300], 20)
    got = neighbours.nearest(frame(spark, [*rows, rows[3], rows[20]]), F.col("vec_id") % 20 == 0).collect()
    seen = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        seen.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert {q: [i for _, i in x] for q, x in seen.items()} == {q: [i for _, i in x] for q, x in want.items()}
    few = neighbours.nearest(frame(spark, rows[:5]), F.col("vec_id") % 20 == 0).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2, 3, 4]
    assert neighbours.nearest(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_hilbert_curve_visits_every_cell_by_unit_steps():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = neighbours.hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        path = grid[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_rows_that_share_an_id_give_the_best_of_their_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i % 50, rng.normal(size=4).astype(np.float32).tolist()) for i in range(150)]  # three vectors an id
    best = {}
    for q, u in rows:
        for i, v in rows:
            if q % 20 == 0 and i != q:
                score = 0.0
                for a, b in zip(u, v):
                    score += a * b
                best[q, i] = max(score, best.get((q, i), -np.inf))
    want = {q: [i for _, i in sorted((-s, i) for (p, i), s in best.items() if p == q)[:20]] for q in (0, 20, 40)}
    for parts in (1, 5):  # in any order of the rows
        got = neighbours.nearest(frame(spark, rows[::-1] if parts == 5 else rows).repartition(parts), F.col("vec_id") % 20 == 0).collect()
        found = {}
        for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
            found.setdefault(r["query_id"], []).append(r["vec_id"])
            assert r["score"] == best[r["query_id"], r["vec_id"]]
        assert found == want


def test_a_vector_that_a_third_shares_leaves_no_empty_segments():
    rng = np.random.default_rng(4)
    sample = np.vstack([np.tile(rng.normal(size=8), (400, 1)), rng.normal(size=(800, 8))])
    curves = neighbours.Curves(sample, 3, 20, 4, 8, 1)
    for o, cells in enumerate(curves.cells(sample).T):
        used = np.unique(cells) - o * 20
        assert len(used) == len(curves.bounds[o]) + 1 or used.tolist() == list(range(used[0], used[0] + len(used)))
        assert len(used) < 20
