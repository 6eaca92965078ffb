"""Substring deduplication: words that repeat a passage of an earlier document go.

Every window of ``width`` consecutive words has a Rabin-Karp hash: a polynomial
of the words' hashes modulo 2**64, taken for all windows at once from one running
sum.  Two such hashes with different bases are mixed into the 64 bits that travel.

Consecutive windows that share their minimizer (the least hash of four words in
the window) travel together to the shard of that minimizer, some 24 at a time:
equal windows have equal minimizers, positions follow from the first one, and a
shard's answer is again an interval.  Before anything is sent, a task compares
the windows of about four megabytes of text: those that also start in a smaller
document of the same slice are repeated whatever others hold, so only the
smallest document's go on.  A passage that a third of all documents share thus
sends one hash per window and slice.

A shard counts what it gets and answers with the intervals of windows that start
in a smaller document as well.  The intervals of a document are merged into
maximal ones and cut out of its words.

Shards hold about 8 MB of text each and their number grows with the input, so two
different windows are taken for one with a chance of 2**-64 for each pair in a
shard: below one window in 100 TB.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import by_bytes, bytes_of

NO_ID = (1 << 63) - 1  # stands for a NULL id, after all others
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so that they have inverses modulo 2**64
GRAM = 4
SLICE_BYTES = 4 << 20
SEGMENT_WORDS = 1 << 20  # longer documents are hashed in overlapping parts
REMEMBERED_WORDS = 500_000
RUN = np.dtype([("owner", "<i8"), ("check", "<i8"), ("start", "<i8"), ("count", "<i4")])
INTERVAL = np.dtype([("owner", "<i8"), ("check", "<i8"), ("start", "<i8"), ("stop", "<i8")])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64."""
    def of(b: int) -> np.ndarray:
        steps = np.full(n, b, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)
    return of(base), of(pow(base, -1, 1 << 64))


def rolling(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash of every ``width`` consecutive values."""
    n = len(values)
    powers, inverse = _powers(base, max(SEGMENT_WORDS, 1 << max(n - 1, 0).bit_length()))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * inverse[:n], out=sums[1:])
    return (sums[width:] - sums[:-width]) * powers[width - 1:n]


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    out, span, n = x, 1, len(x) - size + 1
    while 2 * span <= size:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return out[:n] if span == size else np.minimum(out[:n], out[size - span:size - span + n])


class WordHashes:
    """128-bit hashes of words; forgets all at the bound."""

    def __init__(self):
        self.known, self.digests = {}, bytearray()

    def of(self, split: list[list[bytes]]) -> np.ndarray:
        words = set().union(*split)
        if len(self.known) > REMEMBERED_WORDS:
            self.known, self.digests = {}, bytearray()
        new = [w for w in words if w not in self.known]
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.digests += b"".join(map(xxhash.xxh3_128_digest, new))
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64)
        return np.frombuffer(bytes(self.digests), "<u8").reshape(-1, 2)[at]


def _starts(breaks: np.ndarray) -> np.ndarray:
    """Places where a run starts: the first, and every one after a break."""
    return np.flatnonzero(np.concatenate([[True], breaks]))


def slice_windows(parts: list[tuple[int, int, int, list[bytes]]], width: int, hashes: WordHashes):
    """Runs of windows to send, their minimizers and hashes, and the intervals that are repeated within the slice.

    ``parts`` are ``(owner, check, first word, words)``.
    """
    parts = sorted((p for p in parts if len(p[3]) >= width), key=lambda p: p[0])
    if not parts:
        return np.empty(0, RUN), np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, INTERVAL)
    owner, check, first = (np.array([p[k] for p in parts], np.int64) for k in range(3))
    sizes = np.array([len(p[3]) for p in parts])
    values = hashes.of([p[3] for p in parts])
    with np.errstate(over="ignore"):
        one = rolling(values[:, 0].copy(), width, BASES[0])
        two = rolling(values[:, 1].copy(), width, BASES[1])
        whole = _mix(one + _mix(two))
        gram = min(GRAM, width)
        least = sliding_min(_mix(rolling(values[:, 0].copy(), gram, BASES[1])), width - gram + 1)
    part = np.repeat(np.arange(len(parts)), sizes)
    at = np.flatnonzero(part[:len(whole)] == part[width - 1:])  # windows that lie in one document
    part, position = part[at], first[part[at]] + at - (np.cumsum(sizes) - sizes)[part[at]]
    whole, two, least = whole[at], two[at], least[at]
    # Equal windows side by side, smaller owners first.
    order = np.argsort(whole, kind="stable")
    group = _starts((whole[order][1:] != whole[order][:-1]) | (two[order][1:] != two[order][:-1]))
    owners = owner[part[order]]
    lost = np.empty(len(at), bool)
    lost[order] = owners > np.repeat(owners[group], np.diff(np.append(group, len(owners))))
    gone, sent = np.flatnonzero(lost), np.flatnonzero(~lost)
    known = intervals(owner[part[gone]], check[part[gone]], position[gone], part[gone], width)
    run = _starts((np.diff(sent) > 1) | (np.diff(part[sent]) != 0) | (least[sent][1:] != least[sent][:-1]))
    runs = np.empty(len(run), RUN)
    head = sent[run]
    runs["owner"], runs["check"], runs["start"] = owner[part[head]], check[part[head]], position[head]
    runs["count"] = np.diff(np.append(run, len(sent)))
    return runs, least[head], whole[sent], known


def intervals(owner, check, position, part, width: int) -> np.ndarray:
    """Words that windows at ascending places of their documents cover, adjacent windows merged."""
    if not len(position):
        return np.empty(0, INTERVAL)
    start = _starts((np.diff(position) != 1) | (np.diff(part) != 0))
    last = np.append(start[1:], len(position)) - 1
    out = np.empty(len(start), INTERVAL)
    out["owner"], out["check"], out["start"], out["stop"] = owner[start], check[start], position[start], position[last] + width
    return out


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive pieces of an array, of so many bytes each, as binary values."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


def _packs(runs, least, hashes, known, shards: int, turn: int) -> Iterator[pa.RecordBatch]:
    names = ["shard", "runs", "hashes", "known"]
    if len(runs):
        with np.errstate(over="ignore"):
            shard = (_mix(least + np.uint64(1)) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        counts = runs["count"][order].astype(np.int64)
        begin = (np.cumsum(runs["count"]) - runs["count"])[order]
        moved = hashes[np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(len(hashes))]
        pack = _starts(np.diff(shard[order]) != 0)
        n_runs = np.diff(np.append(pack, len(runs)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(shard[order][pack]), _binary(runs[order], RUN.itemsize * n_runs),
             _binary(moved, 8 * np.add.reduceat(counts, pack)), pa.array([b""] * len(pack), pa.binary())], names)
    if len(known):
        yield pa.RecordBatch.from_arrays([pa.array([turn % shards], pa.int64()), *[pa.array([x], pa.binary()) for x in
                                          (b"", b"", known.tobytes())]], names)


def repeated_intervals(docs: DataFrame, width: int = 50, shard_bytes: int = 8 << 20) -> DataFrame:
    """``owner, check, spans``: per row the word intervals that windows of smaller owners repeat; others are left out.

    ``docs`` has ``owner``, ``check`` (hash of the text) and ``text``.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // shard_bytes)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, turn = WordHashes(), 0
        for batch in batches:
            for slice_ in by_bytes(batch, "text", SLICE_BYTES):
                own = {(o, c): text for o, c, text in zip(slice_.column("owner").to_pylist(), slice_.column("check").to_pylist(),
                                                          bytes_of(slice_, "text"))}  # repeated rows once
                parts, held = [], 0
                for (o, c), text in own.items():
                    words = text.split()
                    for begin in range(0, max(len(words) - width + 1, 0), SEGMENT_WORDS):
                        piece = words[begin:begin + SEGMENT_WORDS + width - 1]
                        if held + len(piece) > 2 * SEGMENT_WORDS:
                            yield from _packs(*slice_windows(parts, width, hashes), shards, turn := turn + 1)
                            parts, held = [], 0
                        parts.append((o, c, begin, piece))
                        held += len(piece)
                yield from _packs(*slice_windows(parts, width, hashes), shards, turn := turn + 1)

    def answer(group: pa.Table) -> pa.Table:
        read = lambda name, kind: np.frombuffer(b"".join(x.as_buffer() for x in group.column(name)), kind)
        runs, hashes, found = read("runs", RUN), read("hashes", "<u8"), [read("known", INTERVAL)]
        if len(hashes):
            run = np.repeat(np.arange(len(runs)), runs["count"])
            owner = runs["owner"][run]
            order = np.argsort(hashes, kind="stable")
            start = _starts(hashes[order][1:] != hashes[order][:-1])
            least = np.minimum.reduceat(owner[order], start)
            lost = np.empty(len(hashes), bool)
            lost[order] = owner[order] > np.repeat(least, np.diff(np.append(start, len(order))))
            gone = np.flatnonzero(lost)
            place = runs["start"][run] + np.arange(len(run)) - (np.cumsum(runs["count"]) - runs["count"])[run]
            found.append(intervals(owner[gone], runs["check"][run[gone]], place[gone], run[gone], width))
        found = np.concatenate(found)
        return pa.table({name: found[name].copy() for name in INTERVAL.names})

    packs = docs.select("owner", "check", "text").mapInArrow(send, "shard long, runs binary, hashes binary, known binary")
    found = packs.groupBy("shard").applyInArrow(answer, "owner long, check long, start long, stop long")
    return found.groupBy("owner", "check").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Maximal intervals, ascending."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return out


def dedup_substrings(docs: DataFrame, width: int = 50, carry: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the carried columns), ``kept_text``, ``n_words``, ``n_removed``, ``spans``.

    ``docs`` needs ``doc_id`` (integer), ``text``.  Words are what lies between
    ASCII blanks; ``spans`` are the removed intervals ``[start, stop)`` of words,
    maximal and ascending, and the kept words are joined by one space.  A word
    goes if a window over it also starts in a row with a smaller id, judged on
    the input.  NULL and empty texts and those shorter than a window lose
    nothing.  Rows that share an id are one document and take nothing from each
    other; so are rows with NULL ids, after all others.  Repeated rows have equal
    results.  An empty table gives an empty result.
    """
    carry = docs.columns if carry is None else carry
    own = docs.select(F.struct(*[docs[c] for c in carry]).alias("row"), docs["text"].alias("text"),
                      F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("owner"),
                      F.xxhash64(docs["text"]).alias("check"))
    marked = own.join(repeated_intervals(own, width), ["owner", "check"], "left").select("row", "text", "spans")
    schema = (f"row {marked.schema['row'].dataType.simpleString()}, kept_text string, n_words long, n_removed long, "
              "spans array<array<long>>")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                kept, n, n_removed, cuts = [], [], [], []
                for text, spans in zip(bytes_of(part, "text"), part.column("spans").to_pylist()):
                    words = text.split()
                    whole = merged([(s["start"], s["stop"]) for s in spans or ()])
                    n.append(len(words))
                    n_removed.append(sum(stop - start for start, stop in whole))
                    for start, stop in reversed(whole):
                        del words[start:stop]
                    kept.append(b" ".join(words))
                    cuts.append(whole)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()),
                     pa.array(n_removed, pa.int64()), pa.array(cuts, pa.list_(pa.list_(pa.int64())))],
                    ["row", "kept_text", "n_words", "n_removed", "spans"])

    return marked.mapInArrow(cut, schema)


SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM docs WHERE len(words) >= 50)),
lost AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first FROM windows) WHERE first < doc_id),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM lost),
spread AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM docs),
kept AS (
  SELECT s.doc_id, string_agg(word, ' ' ORDER BY s.pos) FILTER (c.pos IS NULL) AS text, count(c.pos) AS n
  FROM spread s LEFT JOIN covered c ON c.doc_id = s.doc_id AND c.pos = s.pos GROUP BY s.doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(k.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""
