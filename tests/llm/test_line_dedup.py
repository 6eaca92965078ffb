import numpy as np

from panelcast.llm import line_dedup, perfect_hash


def brute(rows):
    holders = {}
    keys = lambda text: [x.strip(b" \t\n\x0b\x0c\r").lower() for x in (text or "").encode().split(b"\n")]
    order = lambda i: (i is None, i or 0)
    for i, text in rows:
        for key in keys(text):
            if len(key.decode()) >= 10:
                holders.setdefault(key, set()).add(order(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x, key in zip(lines, keys(text)) if len(holders.get(key, ())) < 2 or min(holders[key]) == order(i)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def rows_of(prose):
    shared = [prose(8, 1000 + k) for k in range(30)]
    rows = [(i, "\n".join([shared[i % 30], prose(9, i), "  " + shared[(i * 7) % 30].upper() + "\t", "short", shared[i % 30]])) for i in range(200)]
    rows += [(i, "THE hot line everyone has\n" + prose(3, i)) for i in range(300, 400)]
    rows += [(500, None), (501, ""), (502, "\n\n"), (None, shared[0]), (None, shared[1] + "\nnull only line"), (503, "éééééééééé"), (504, "ÉÉÉÉÉÉÉÉÉÉ"),
             (505, "éééééééééé "), (7, rows[7][1]), (506, "short\n123456789\n" + "x" * 300_000), (507, "x" * 300_000 + "\r\n" + "a b" * 5)]
    return rows


def test_equals_brute_force(documents, prose):
    rows = rows_of(prose)
    got = line_dedup.dedup_lines(documents(rows).repartition(5)).collect()
    seen = sorted(((r["row"]["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"]) for r in got), key=repr)
    assert seen == brute(rows)
    assert line_dedup.dedup_lines(documents([])).count() == 0
    assert set(got[0]["row"].asDict()) == set(documents([]).columns)


def test_perfect_hash():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000, 50_000):
        high, low = rng.integers(0, 1 << 63, n).astype(np.uint64), rng.integers(0, 5, n).astype(np.uint64)
        function = perfect_hash.build(high, low)
        assert (np.sort(perfect_hash.find(function, high, low)) == np.arange(n)).all()
        assert len(function) <= 100 + n  # under 8 bits a key
        strangers = perfect_hash.find(function, high + np.uint64(1), low)
        assert len(strangers) == n and (strangers < max(n, 1)).all()
