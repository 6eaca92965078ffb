"""The trie of conversation prefixes, built in range-partitioned shards around a skeleton of splitter paths.

A turn is 128 bits of its role and text and the length of the text; texts do not
travel.  A conversation is a path of such turns.  Splitters are paths (with ids,
so that copies of one conversation part as well) at even ranks of a sample; the
sample moves the borders and nothing else.  Nodes on the way to a splitter are the
skeleton: only these can have members in several shards.  The skeleton is a trie
with a node for each turn of each splitter, and goes to every task.

A shard's conversations are sorted by path and id and read once, with the nodes
of the current path on a stack.  A node that is not in the skeleton is finished
when the path leaves it.  Skeleton nodes leave partial aggregates: members,
finished children, their leaves and savings, and the ids that end there.  These
are reduced by node, then summed up the skeleton, which is as small as the list of
splitters.  The ids that end at a node are sorted in each shard and shards follow
each other, so pieces of the list are digested in order and never held whole.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.session import materialize

TURN = 32  # hexadecimal digits of a turn
ENDS_BYTES = 1 << 16  # of a piece of a list of ids
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string")
OUT = NODE + ", node string, parent string, turn_bytes long, shard int, ends string"
FIELDS = [f.split()[0] for f in OUT.split(", ")]


def _turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos`` (from 1), ``turn`` (digest), ``bytes``; a role's length parts it from the text."""
    role, text = (F.coalesce(conversations[c], F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].cast("long").alias("conv_id"), conversations["turn"].alias("order"),
        F.substring(F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text)), 256), 1, TURN).alias("turn"),
        F.octet_length(text).cast("long").alias("bytes"))
    place = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("order"), "turn")
    return turns.withColumn("pos", F.row_number().over(place)).select("conv_id", "pos", "turn", "bytes")


def _collected(turns: DataFrame, *order: str) -> DataFrame:
    """``conv_id, path, sizes``: digests of the turns in order, one string, and their bytes."""
    inside = F.filter(F.sort_array(F.collect_list(F.struct(*order, "turn", "bytes"))), lambda t: t["turn"].isNotNull())
    return turns.groupBy("conv_id").agg(inside.alias("turns")).select(
        "conv_id", F.array_join(F.col("turns.turn"), "").alias("path"), F.col("turns.bytes").alias("sizes"))


def paths(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, path, sizes``.

    ``conversations`` needs ``conv_id`` (integer), ``turn``, ``role``, ``text``.
    Turns are in order of ``turn``, NULL first, equal ones in order of their
    digests; NULL roles and texts are empty; rows without ``conv_id`` belong to
    no conversation.
    """
    return _collected(_turns(conversations), "pos")


def heads_taken(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % 9).cast("int")


def rebuilt(conversations: DataFrame, family: int = 5) -> DataFrame:
    """As ``paths``, after every conversation has got new first turns.

    Conversation ``c`` takes the first ``h = crc32(c) % 9`` turns of conversation
    ``c - c % family`` (none if absent) and keeps its own after its first ``h``.
    """
    turns = materialize(_turns(conversations), "turns")
    own = turns.filter(F.col("pos") > heads_taken(F.col("conv_id"))).select("conv_id", F.lit(1).alias("part"), "pos", "turn", "bytes")
    there = turns.filter("pos = 1").select("conv_id", F.lit(2).alias("part"), "pos", F.lit(None).cast("string").alias("turn"),
                                           F.lit(None).cast("long").alias("bytes"))
    step = F.explode(F.sequence(F.lit(1 - family), F.lit(family - 1))).alias("step")
    lent = turns.filter((F.col("conv_id") % family == 0) & (F.col("pos") <= 8)) \
        .select("conv_id", F.lit(0).alias("part"), "pos", "turn", "bytes", step).withColumn("taker", F.col("conv_id") + F.col("step")) \
        .filter((F.col("taker") - F.col("taker") % family == F.col("conv_id")) & (F.col("pos") <= heads_taken(F.col("taker")))) \
        .select(F.col("taker").alias("conv_id"), "part", "pos", "turn", "bytes")
    # A family's loans to conversations that do not exist are dropped where the turns are put together.
    parts = own.unionByName(lent).unionByName(there)
    exists = F.max("part") == 2
    inside = F.filter(F.sort_array(F.collect_list(F.struct("part", "pos", "turn", "bytes"))), lambda t: t["turn"].isNotNull())
    return parts.groupBy("conv_id").agg(exists.alias("exists"), inside.alias("turns")).filter("exists").select(
        "conv_id", F.array_join(F.col("turns.turn"), "").alias("path"), F.col("turns.bytes").alias("sizes"))


def splitters(convs: DataFrame, n_convs: int, shards: int, per_shard: int = 100) -> list[tuple[str, int]]:
    """At most ``shards - 1`` borders at even ranks of about ``per_shard * shards`` paths, those with the least hashes."""
    step = max(1, n_convs // (per_shard * shards))
    sample = sorted(map(tuple, convs.filter(F.pmod(F.xxhash64("conv_id"), F.lit(step)) == 0).select("path", "conv_id").collect()))
    return sorted({sample[len(sample) * i // shards] for i in range(1, shards)}) if sample else []


class Node:
    """What is known of a node while the path is below it."""

    __slots__ = ("key", "depth", "bytes", "least", "members", "children", "leaves", "saved", "digest", "ends", "held", "kept")

    def __init__(self, key: str, depth: int, size: int, skeleton: bool):
        self.key, self.depth, self.bytes = key, depth, size
        self.least, self.members, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.digest, self.ends, self.held = None if skeleton else hashlib.sha256(), [], 0
        self.kept: list[dict] = []  # finished children that wait for this node's conv_id


def trie_nodes(rows: Iterator[tuple[int, str, list[int], int]], skeleton: set[str]) -> Iterator[dict]:
    """Nodes of one shard's sorted ``(conv_id, path, sizes, shard)``; rows of the skeleton are partial."""
    stack: list[Node] = []
    path, shard = "", -1

    def ends_of(node: Node) -> dict:
        piece, node.ends, node.held = ",".join(node.ends), [], 0
        return {"node": node.key, "depth": node.depth, "shard": shard, "ends": piece}

    def leave() -> Iterator[dict]:
        node = stack.pop()
        parent = stack[-1] if stack else None
        if node.digest is None:
            if node.ends:
                yield ends_of(node)
            yield {"node": node.key, "parent": parent and parent.key, "conv_id": node.least, "depth": node.depth, "n_convs": node.members,
                   "n_children": node.children, "n_leaves": node.leaves, "saved_tokens": node.saved, "turn_bytes": node.bytes, "shard": shard}
        else:
            leaves, saved = node.leaves or 1, node.saved + (node.members - 1) * node.bytes
            for child in node.kept:
                yield child | {"parent_conv_id": node.least}
            own = {"conv_id": node.least, "depth": node.depth, "n_convs": node.members, "n_children": node.children, "n_leaves": leaves,
                   "saved_tokens": saved, "ends_sha256": node.digest.hexdigest()}
            parent.children += 1
            parent.leaves += leaves
            parent.saved += saved
            if parent.digest is None:
                yield own | {"parent": parent.key}
            else:
                parent.kept.append(own)
        if parent:
            parent.members += node.members
            parent.least = node.least if parent.least is None else min(parent.least, node.least)

    for conv, new, sizes, new_shard in rows:
        if new_shard != shard:
            while stack:
                yield from leave()
            shard, path = new_shard, ""
            stack.append(Node("", 0, 0, True))
        shared = 0
        limit = min(len(path), len(new)) // TURN
        while shared < limit and path[shared * TURN:(shared + 1) * TURN] == new[shared * TURN:(shared + 1) * TURN]:
            shared += 1
        while len(stack) > shared + 1:
            yield from leave()
        for depth in range(shared + 1, len(new) // TURN + 1):
            key = new[:depth * TURN]
            stack.append(Node(key, depth, sizes[depth - 1], key in skeleton))
        top, path = stack[-1], new
        top.members += 1
        top.least = conv if top.least is None else min(top.least, conv)
        if top.digest is None:
            top.ends.append(str(conv))
            top.held += len(top.ends[-1]) + 1
            if top.held > ENDS_BYTES:
                yield ends_of(top)
        else:
            top.digest.update(f",{conv}".encode() if top.held else str(conv).encode())
            top.held = 1
    while stack:
        yield from leave()


def ends_digests(pieces: DataFrame) -> DataFrame:
    """``node, ends_sha256``: digest of a node's pieces in order, one piece in memory at a time."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], ["node", "ends_sha256"])
        for batch in batches:
            for key, piece in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
                if key == node:
                    state.update(b",")
                else:
                    if state:
                        yield row()
                    node, state = key, hashlib.sha256()
                state.update(piece.encode())
        if state:
            yield row()

    return pieces.repartition("node").sortWithinPartitions("node", "shard", "piece").select("node", "ends") \
        .mapInArrow(digest, "node string, ends_sha256 string")


def skeleton_totals(partial: list[dict]) -> list[dict]:
    """Totals of the skeleton's nodes (one dict each, deepest last or not) over the skeleton below them."""
    nodes = {n["node"]: dict(n) for n in partial}
    for n in sorted(nodes.values(), key=lambda n: -n["depth"]):
        n["n_leaves"] = n["n_leaves"] or int(not n["n_children"])
        n["saved_tokens"] += (n["n_convs"] - 1) * n["turn_bytes"]
        if n["parent"] is not None:
            parent = nodes[n["parent"]]
            parent["n_children"] += 1
            for field in ("n_leaves", "saved_tokens"):
                parent[field] += n[field]
    for n in nodes.values():
        n["parent_conv_id"] = None if n["parent"] is None else nodes[n["parent"]]["conv_id"]
    return list(nodes.values())


def prefix_trie(convs: DataFrame, convs_per_shard: int = 50_000) -> DataFrame:
    """One row per distinct prefix of the conversations ``conv_id, path, sizes`` (from ``paths`` or ``rebuilt``).

    ``conv_id`` is the smallest member's, ``parent_conv_id`` the parent's (NULL
    for the root), ``n_convs`` members, ``n_children``, ``n_leaves`` childless
    nodes in the subtree, ``saved_tokens`` (members less one, times the bytes of
    the last text, over the subtree), ``ends_sha256`` of the ascending ids that
    end there.  Conversations without turns end at the root.  Without
    conversations there is no node, not even the root.  A conversation's digests,
    32 bytes a turn, must fit a task.
    """
    spark = convs.sparkSession
    convs = materialize(convs, "paths")
    n_convs = convs.count()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_convs // convs_per_shard)
    borders = splitters(convs, n_convs, shards)
    skeleton = {"", *(path[:end] for path, _ in borders for end in range(TURN, len(path) + 1, TURN))}

    @F.pandas_udf("int")
    def shard_of(path, conv_id):
        import pandas as pd
        return pd.Series([bisect.bisect_right(borders, key) for key in zip(path, conv_id)], dtype="int32")

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "path", "sizes", "shard")))

        held = []
        for node in trie_nodes(rows(), skeleton):
            held.append(node)
            if len(held) == 5_000:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        yield pa.RecordBatch.from_pylist(held, schema)

    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in OUT.split(", ")])
    sorted_ = convs.withColumn("shard", shard_of("path", "conv_id")).repartition(shards, "shard") \
        .sortWithinPartitions("shard", "path", "conv_id")
    # A piece's number in its task: pieces of a node come in order from one task.
    found = materialize(sorted_.mapInArrow(nodes, OUT).withColumn("piece", F.monotonically_increasing_id()), "trie")
    finished = found.filter("node IS NULL")
    partial = found.filter("node IS NOT NULL AND ends IS NULL").groupBy("node", "parent", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("turn_bytes").alias("turn_bytes"))
    # One row per turn of a splitter, of which there are as many as shards.
    totals = skeleton_totals([r.asDict() for r in partial.collect()])
    small = spark.createDataFrame([[n[c] for c in ("node", *NODE_NAMES[:-1])] for n in totals],
                                  "node string, " + NODE.rsplit(", ", 1)[0])
    digests = ends_digests(found.filter("ends IS NOT NULL").select("node", "shard", "piece", "ends"))
    top = small.join(digests, "node", "left").select(
        *NODE_NAMES[:-1], F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
    parents = small.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_id"))
    below = finished.join(parents, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "parent_id"))
    return top.unionByName(below.select(*NODE_NAMES))


NODE_NAMES = [f.split()[0] for f in NODE.split(", ")]

SQL = r"""
WITH turns AS (
  SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS turn,
         strlen(coalesce(text, '')) AS bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM turns),
heads AS (
  SELECT conv_id, xor(list_reduce(flatten(list_transform(range(0, len(s)),
           lambda i: [ascii(substr(s, i + 1, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
           lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
           4294967295::BIGINT), 4294967295::BIGINT) % 9 AS h FROM ids),
parts AS (
  SELECT t.conv_id, 1 AS part, pos, turn, bytes FROM turns t JOIN heads USING (conv_id) WHERE pos > h
  UNION ALL
  SELECT h.conv_id, 0, pos, turn, bytes FROM heads h JOIN turns t ON t.conv_id = h.conv_id - h.conv_id % 5 WHERE pos <= h),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth FROM parts),
prefixes AS (
  SELECT conv_id, depth, bytes, string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM placed
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM ids),
members AS (SELECT *, max(depth) OVER (PARTITION BY conv_id) = depth AS ends FROM prefixes),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY path, depth),
linked AS (SELECT n.*, p.path AS parent, p.conv_id AS parent_conv_id
           FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, 32 * (n.depth - 1))),
children AS (SELECT parent AS path, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent),
counted AS (SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN children USING (path)),
sums AS (
  SELECT left(path, 32 * up) AS path, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * bytes) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM counted) GROUP BY 1)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM counted JOIN sums USING (path)
"""
