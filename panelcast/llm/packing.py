"""Packing tokenized documents into sequences by bounded-space best-fit.

Only documents longer than a sequence are cut.  Pieces are packed in the order
in which they come to a task: each goes to the fullest open bin that has room.
Open bins are a bit set over their free space, so the fullest bin with room for
``n`` is the lowest set bit from ``n`` on.  The number of open bins is fixed; if
no bin has room and all are open, the fullest is closed.  A task packs about
``sequences_per_task`` sequences, so the bins left open at its end are few
beside those it fills.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from panelcast.llm.common import by_bytes, bytes_of
from panelcast.llm.token_counts import load_tokenizer
from panelcast.session import materialize

REMEMBERED_WORDS = 800_000
SYMBOLS = b".,;:!?#$%&*"
PROBES = [w.encode() for w in ("a", "the", "straightforwardly", "naïve", "größenwahn", "ñandú", "привет", "日本語", "ʰªß")]
# Letters that stand for bytes in byte-level vocabularies: printable bytes for themselves, others from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: b if b in _PRINTED else 256 + sum(x not in _PRINTED for x in range(b)) for b in range(256)}
PIECE = "piece int, start long, length long, ids_crc32 long"


def _letters(word: bytes) -> bool:
    """Whether a word is letters alone, also when composed and in lower case."""
    return word.isalpha() or (text := word.decode()).isalpha() and unicodedata.normalize("NFC", text).lower().isalpha()


def _settled(text: str) -> bool:
    """Whether lower case and composition of letters change nothing."""
    return text == text.lower() and unicodedata.is_normalized("NFC", text)


class WordIds:
    """Ids of words as little-endian 32-bit bytes; forgets all at the bound.

    For tokenizers that drop blanks before they look at words: what lies between
    ASCII blanks is encoded alike alone and in the text.  Words of letters are one
    unit to such a tokenizer.  Where its model, asked without the steps before it,
    gives the same ids, lower-case words go to the model; other words of letters
    are encoded many at a time and told apart by the tokens that end a word.
    """

    def __init__(self, tokenizer, word_end: str = "</w>"):
        self.tokenizer, self.known = tokenizer, {}
        vocabulary = tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(word_end)]] = True
        # Whether the model alone gives what the whole tokenizer gives for lower-case words of letters.
        self.direct = all(self._by_model(w) == ids.tobytes() for w, ids in zip(PROBES, self._encode(PROBES)))

    def _by_model(self, word: bytes) -> bytes:
        return array("I", [t.id for t in self.tokenizer.model.tokenize(word.decode("latin-1").translate(BYTE_LETTERS))]).tobytes()

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in encoded]

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        new = {w for w in words if w not in self.known}  # a difference of sets would walk over all known words
        if not new:
            return self.known
        if len(self.known) > REMEMBERED_WORDS:
            self.known = {w: self.known[w] for w in words & self.known.keys()}
        # Symbols after letters are a unit of their own to the tokenizer.
        stems = {w: stem for w in new if (stem := w.rstrip(SYMBOLS)) and len(stem) < len(w) and _letters(stem)}
        parts = chain(new.difference(stems), stems.values(), {w[len(stem):] for w, stem in stems.items()})
        plain = {w for w in parts if w not in self.known}
        letters = [w for w in plain if _letters(w)]
        others = list(plain.difference(letters))
        if self.direct:
            lower = [w for w in letters if w.isalpha() and w.islower() or _settled(w.decode())]
            self.known.update(zip(lower, map(self._by_model, lower)))
            letters = list(set(letters).difference(lower))
        blocks = [letters[i:i + 500] for i in range(0, len(letters), 500)]
        for block, ids in zip(blocks, self._encode([b" ".join(block) for block in blocks])):
            raw, cuts = ids.tobytes(), [0, *(4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()]
            if len(cuts) == len(block) + 1:
                self.known.update(zip(block, map(raw.__getitem__, map(slice, cuts, cuts[1:]))))
            else:  # a letter that is more than letters to the tokenizer
                others += block
        self.known.update(zip(others, (ids.tobytes() for ids in self._encode(others))))
        self.known.update([(w, self.known[stem] + self.known[w[len(stem):]]) for w, stem in stems.items()])
        return self.known


@lru_cache(maxsize=1)
def word_ids(tokenizer_path: str) -> WordIds:
    """The worker's memory of words, which later tasks of the worker go on with."""
    return WordIds(load_tokenizer(tokenizer_path))


def document_ids(texts: list[bytes], words: WordIds, end_id: int) -> list[bytes]:
    # The tokenizer lower-cases, but finds special strings as they are written.
    split = [(text if b"<|" in text else text.lower()).split() for text in texts]
    known = words.learn(set().union(*split))
    end = np.array([end_id], "<u4").tobytes()
    return [b"".join(map(known.__getitem__, parts)) + end for parts in split]


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, length: int = 4096, end_id: int = 1,
                    carry: list[str] | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``length`` ids: ``row, piece, start, length, ids_crc32`` and, if asked for, ``ids``."""
    carry = docs.columns if carry is None else carry
    packed = docs.select(F.struct(*[docs[c] for c in carry]).alias("row"), docs["text"].alias("text"))
    schema = f"row {packed.schema['row'].dataType.simpleString()}, {PIECE}" + ", ids binary" * with_ids

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer_path)
        for batch in batches:
            for part in by_bytes(batch, "text", 1 << 20):
                owner, piece, start, size, crc, held = [], [], [], [], [], []
                for i, ids in enumerate(document_ids(bytes_of(part, "text"), words, end_id)):
                    for k, at in enumerate(range(0, len(ids), 4 * length)):
                        own = ids[at:at + 4 * length]
                        owner.append(i)
                        piece.append(k)
                        start.append(at // 4)
                        size.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                        held.append(own)
                columns = [part.column("row").take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
                           pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
                names = ["row", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(held, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return packed.mapInArrow(tokenize, schema)


def best_fit(lengths: list[int], capacity: int, open_bins: int, bins: dict | None = None):
    """Bin number and offset of each length; state is kept in ``bins`` between calls."""
    state = bins if bins is not None else {}
    free: int = state.setdefault("free", 0)  # bit f: an open bin with f places left
    at = state.setdefault("at", {})  # places left -> bins
    n_open, made = state.setdefault("open", 0), state.setdefault("made", 0)
    where, offset = [], []
    for n in lengths:
        room = free >> n
        if room:
            left = n + (room & -room).bit_length() - 1
            name = at[left].pop()
        else:
            if n_open == open_bins:  # close the fullest
                left = (free & -free).bit_length() - 1
                at[left].pop()
                n_open -= 1
                if not at[left]:
                    del at[left]
                    free &= ~(1 << left)
            left, name = capacity, made
            made += 1
            n_open += 1
        if left in at and not at[left]:
            del at[left]
            free &= ~(1 << left)
        where.append(name)
        offset.append(capacity - left)
        left -= n
        if left:
            at.setdefault(left, []).append(name)
            free |= 1 << left
        else:
            n_open -= 1
    state.update(free=free, open=n_open, made=made)
    return where, offset


def pack(pieces: DataFrame, order: list[str], capacity: int = 4096, open_bins: int = 256,
         sequences_per_task: int = 8192) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (``length`` of 1 to ``capacity``).

    Pieces are dealt to tasks by the hash of ``order`` and sorted by it, so a
    repeated task packs alike.  Sequences of different tasks have different ids.
    """
    total = pieces.agg(F.sum("length")).first()[0] or 0
    parts = max(1, -(-total // (capacity * sequences_per_task)))
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in pieces.schema)}, sequence_id long, offset long"
    if {"sequence_id", "offset"} & set(pieces.columns):
        raise ValueError("pieces have a column named sequence_id or offset; carry it in a struct")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, bins = TaskContext.get().partitionId() << 40, {}
        for batch in batches:
            where, offset = best_fit(batch.column("length").to_pylist(), capacity, open_bins, bins)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.array(where, np.int64) + first), pa.array(offset, pa.int64())],
                [*batch.schema.names, "sequence_id", "offset"])

    shuffled = F.xxhash64(*order)
    return pieces.withColumn("deal", shuffled).repartition(parts, "deal").sortWithinPartitions("deal", *order) \
        .drop("deal").mapInArrow(fill, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, open_bins: int = 256,
                   sequences_per_task: int = 8192, carry: list[str] | None = None, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place: ``row, piece, start, length, ids_crc32, sequence_id, offset``.

    ``docs`` needs ``doc_id, text``.  A NULL or empty text is the closing id
    alone.  Repeated rows are documents of their own; NULL ids are dealt alike.
    An empty table gives an empty result.
    """
    pieces = materialize(tokenize_pieces(docs.select(F.struct(*[docs[c] for c in (docs.columns if carry is None else carry)])
                                                     .alias("given"), docs["doc_id"].alias("id"), docs["text"]),
                                         tokenizer_path, capacity, end_id, ["given", "id"], with_ids), "pieces")
    flat = pieces.select("row.id", "row.given", *[c for c in pieces.columns if c != "row"])
    packed = pack(flat, ["id", "piece", "ids_crc32"], capacity, open_bins, sequences_per_task)
    return packed.withColumnRenamed("given", "row").drop("id")
