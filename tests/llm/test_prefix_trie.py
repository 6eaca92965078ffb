import hashlib
import random
import zlib
from collections import defaultdict

from panelcast.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, path string, pos int"


def conversations_of(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append(((turn is not None, turn or 0, tie), (role, text)))
    return {c: [t for _, t in sorted(turns)] for c, turns in own.items()}


def rebuild(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = sum(saved[x] for x in children[node]) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), len(children[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items())


def seen(df):
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.collect())


def rows_of():
    rng = random.Random(3)
    rows = []
    for c in range(400):
        for t in range(rng.randrange(1, 12)):
            rows.append((c * 2 if c < 200 else c + 300, t, rng.choice(["user", "assistant", None]), rng.choice("abcdé") * rng.randrange(3), "x", 1))
    rows += [(1000 + c, t, "user", f"hot {t}", "x", 1) for c in range(200) for t in range(4)]  # copies
    rows += [(2000, t, "user", f"deep {t % 3}", "x", 1) for t in range(300)]
    return rows + [(3001, None, None, None, "x", 1), (3001, None, "a", "b", "x", 1), (3001, 1, "a", "b", "x", 1), (3001, 1, "a", "b", "x", 1),
                   (None, 1, "user", "lost", "x", 1), (3003, 0, "ab", "c", "x", 1), (3004, 0, "a", "bc", "x", 1)]


def test_equals_brute_force(spark):
    rows = rows_of()
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    own = conversations_of(rows)
    assert seen(prefix_trie.prefix_trie(prefix_trie.rebuilt(table))) == brute(rebuild(own))
    for per_shard in (20, 5):  # many splitters, also inside copies of one conversation
        assert seen(prefix_trie.prefix_trie(prefix_trie.paths(table), per_shard)) == brute(own)


def test_long_lists_of_ends_come_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ENDS_BYTES", 20)
    rows = [(c, 0, "user", "same") for c in range(300)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert seen(prefix_trie.prefix_trie(prefix_trie.paths(table), 40)) == brute(conversations_of(rows))
    order = [(c, prefix_trie.TURN * "a", [4], 0) for c in range(100)]
    out = list(prefix_trie.trie_nodes(iter(order), {"", prefix_trie.TURN * "a"}))
    assert ",".join(n["ends"] for n in out if "ends" in n) == ",".join(map(str, range(100))) and len(out) > 10


def test_empty(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.prefix_trie(prefix_trie.rebuilt(table)).count() == 0
    alone = spark.createDataFrame([(None, 0, "user", "x", "p", 1)], SCHEMA)
    assert prefix_trie.prefix_trie(prefix_trie.paths(alone)).count() == 0
