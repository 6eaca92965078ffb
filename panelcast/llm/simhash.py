"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are dealt to cells by the bit counts of their parts and
cells are cut into tiles of bounded size.  Only tiles whose bit counts differ by
no more than the radius can hold a link, so a tile meets the tiles of the cells
within that distance, each pair of tiles once.  A pair is compared whole, with
exclusive-or and bit counts on numpy blocks.  From every pair of tiles come the
edges of a spanning forest of its links, at most one per fingerprint, so groups
of thousands of copies do not become pairs, and no connection is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import by_bytes, bytes_of
from panelcast.llm.components import connected
from panelcast.session import materialize

SEED = 42
PART_BITS, PART_BASE = 10, 256  # a part's bit count plus this base in so many bits of the cell


def shingles(text: bytes, width: int) -> list[bytes]:
    """Runs of ``width`` lower-cased words; fewer words are one run, none give none."""
    words = text.lower().split()  # both by ASCII only
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(width)))))


def fingerprint(runs: list[bytes], words: int = 1) -> bytes:
    """``words`` times 64 bits, each set if it is set in over half of the runs' XXH64; zero for no runs."""
    out = []
    for k in range(words):
        ones = np.zeros(64, np.int64)
        for at in range(0, len(runs), 1 << 16):
            block = runs[at:at + (1 << 16)]
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, block, repeat(SEED + k)), np.uint64, len(block))
            bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            ones += bits.sum(axis=0, dtype=np.uint32)
        out.append(np.packbits(2 * ones > len(runs)).tobytes())
    return b"".join(out)


def cell_of(print_: bytes, parts: int) -> int:
    """Bit counts of the fingerprint's equal parts as one number."""
    size, cell = len(print_) // parts, 0
    for i in range(parts):
        count = int.from_bytes(print_[i * size:(i + 1) * size], "big").bit_count()
        cell = cell << PART_BITS | (count + PART_BASE)
    return cell


def cell_steps(parts: int, radius: int) -> list[int]:
    """Differences from a cell to those within the radius, one of each opposite pair."""
    steps = [d for d in product(range(-radius, radius + 1), repeat=parts) if sum(map(abs, d)) <= radius]
    steps = [d for d in steps if d >= (0,) * parts]
    return [sum(x << PART_BITS * (parts - 1 - i) for i, x in enumerate(d)) for d in steps]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component under the links i-j."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            return label


def compare_tiles(left: np.ndarray, right: np.ndarray, radius: int, same: bool) -> np.ndarray:
    """Labels of left then right nodes after linking all pairs within the radius."""
    n = len(left)
    total = n if same else n + len(right)
    label = np.arange(total)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    count, step = 0, max(1, (1 << 18) // max(1, len(right)))
    for at in range(0, n, step):
        distance = np.bitwise_count(left[at:at + step, None, 0] ^ right[None, :, 0])
        for w in range(1, left.shape[1]):
            distance += np.bitwise_count(left[at:at + step, None, w] ^ right[None, :, w])
        i, j = np.nonzero(distance <= radius)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        else:
            j = j + n
        if len(i):
            held.append((i, j))
            count += len(i)
        if count > 1 << 20:
            label = _fold(label, held)
            held, count = [], 0
    return _fold(label, held) if held else label


def _fold(label: np.ndarray, held) -> np.ndarray:
    at = np.arange(len(label))
    i = np.concatenate([at, *[a for a, _ in held]])
    j = np.concatenate([label, *[b for _, b in held]])
    return forest(len(label), i, j)


def _as_array(prints: bytes, n_bytes: int) -> np.ndarray:
    return np.frombuffer(prints, ">u8").astype(np.uint64).reshape(-1, n_bytes // 8)


def fingerprint_links(prints: DataFrame, radius: int, steps: list[int], tile: int = 4096) -> DataFrame:
    """Links ``a, b`` that connect all of the distinct ``print, cell`` within ``radius`` bits of each other.

    ``steps`` are the differences between cells that can hold a link, one of each opposite pair.
    """
    sizes = prints.groupBy("cell").agg(F.ceil(F.count("*") / tile).alias("chunks"))

    def gather(group: pa.Table) -> pa.Table:
        return pa.table({"cell": group.column("cell").slice(0, 1), "chunk": group.column("chunk").slice(0, 1),
                         "prints": [b"".join(sorted(group.column("print").to_pylist()))]})

    tiles = materialize(
        prints.join(sizes, "cell").withColumn("chunk", F.pmod(F.xxhash64("print"), F.col("chunks")))
        .select("cell", "chunk", "print").groupBy("cell", "chunk").applyInArrow(gather, "cell long, chunk long, prints binary"), "tiles")
    n_bytes = prints.select(F.length("print")).first()
    n_bytes = n_bytes[0] if n_bytes else 8
    near = F.array(*[F.lit(s) for s in steps])
    left = tiles.select(F.col("cell").alias("from"), F.col("chunk").alias("left_chunk"), F.col("prints").alias("left"),
                        F.explode(F.transform(near, lambda s: s + F.col("cell"))).alias("cell"))
    pairs = left.join(tiles, "cell").filter((F.col("from") != F.col("cell")) | (F.col("left_chunk") <= F.col("chunk"))) \
        .select("left", F.col("prints").alias("right"),
                ((F.col("from") == F.col("cell")) & (F.col("left_chunk") == F.col("chunk"))).alias("same"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                a, b, same = (batch.column(c)[k].as_py() for c in range(3))
                nodes = a if same else a + b
                label = compare_tiles(_as_array(a, n_bytes), _as_array(b, n_bytes), radius, same)
                moved = np.flatnonzero(label != np.arange(len(label)))
                name = lambda x: nodes[x * n_bytes:(x + 1) * n_bytes]  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([pa.array([name(x) for x in moved], pa.binary()),
                                                  pa.array([name(label[x]) for x in moved], pa.binary())], ["a", "b"])

    parallel = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(parallel).mapInArrow(compare, "a binary, b binary")


def fingerprints(docs: DataFrame, width: int, words: int = 1, parts: int = 1, carry: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the carried columns), ``id``, ``print`` and its ``cell``."""
    carry = docs.columns if carry is None else carry
    row = F.struct(F.struct(*[docs[c] for c in carry]).alias("row"), docs["doc_id"].alias("id"))
    packed = docs.select(row.alias("row"), docs["text"].alias("text"))
    schema = packed.schema["row"].dataType.simpleString()

    def hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                prints = [fingerprint(shingles(t, width), words) for t in bytes_of(part, "text")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(prints, pa.binary()), pa.array([cell_of(p, parts) for p in prints], pa.int64())],
                    ["row", "print", "cell"])

    return packed.mapInArrow(hash_texts, f"row {schema}, print binary, cell long").select("row.*", "print", "cell")


def _grouped(prints: DataFrame, radius: int, parts: int, tile: int) -> DataFrame:
    """``print, group, component`` of ``print, cell, id``: the group's fingerprint that names it, and its smallest id."""
    classes = materialize(prints.groupBy("print", "cell").agg(F.min("id").alias("first")), "print-classes")
    found = connected(fingerprint_links(classes.select("print", "cell"), radius, cell_steps(parts, radius), tile))
    classes = classes.join(found.withColumnsRenamed({"node": "print", "component": "group"}), "print", "left") \
        .withColumn("group", F.coalesce("group", "print"))
    smallest = classes.groupBy("group").agg(F.min("first").alias("component"))
    return classes.join(smallest, "group").select("print", "group", "component")


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2, words: int = 1, parts: int = 4, tile: int = 4096,
                    carry: list[str] | None = None) -> DataFrame:
    """``row``, ``print`` (binary) and ``component``, the smallest id reachable over fingerprints within ``radius``.

    ``docs`` needs ``doc_id, text``.  Texts without words have the zero
    fingerprint and are linked like any other.  Rows with a NULL id belong to
    the component of their fingerprint; a component of such rows alone has a
    NULL component.  Repeated rows are alike.  An empty table gives an empty result.
    """
    prints = materialize(fingerprints(docs, width, words, parts, carry), "prints")
    return prints.join(_grouped(prints, radius, parts, tile), "print").select("row", "print", "component")


def drop_near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2, words: int = 1, parts: int = 4, tile: int = 4096) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component of ``near_duplicates`` the row with the smallest id stays.

    Texts that differ in case or blanks only are copies, texts without words are
    copies of each other.  Rows with a NULL id stay only if their component has
    no other; of rows alike in id one stays.  Columns are those of ``docs``; an
    empty table gives an empty result.
    """
    own = materialize(docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("uid")), "numbered-rows")
    prints = materialize(fingerprints(own.select("row.doc_id", "row.text", "uid"), width, words, parts, ["uid"]), "prints")
    # Copies of a fingerprint are brought to one row before groups meet.
    first = prints.groupBy("print").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row.uid")).alias("first")) \
        .join(_grouped(prints, radius, parts, tile), "print").groupBy("group").agg(F.min("first").alias("first"))
    return own.join(first.select(F.col("first.uid").alias("uid")), "uid", "left_semi").select("row.*")
