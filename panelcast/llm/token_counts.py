"""Token counts of whole texts.

Texts pass through Arrow functions that return lengths only.  A batch is cut into
slices of equal bytes; every text is split at safe boundaries, where no token of
this kind of tokenizer can cross: before a space that a non-blank follows.  The
distinct parts of a slice that were not met before are encoded in one batch, and
their lengths are remembered, within a bound, for the following slices.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import by_bytes, texts_of

# Byte-level BPE puts a space at the start of the word it precedes, and a run of
# blanks leaves its last space to the next word, so parts that start with a
# space and a non-blank are encoded alike alone and in the text.
BOUNDARY = re.compile(r" (?=\S)")
REMEMBERED_CHARS = 8_000_000


@lru_cache(maxsize=2)
def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Lengths:
    """Lengths of words with the space before them; forgets all when the words reach the bound."""

    def __init__(self, tokenizer):
        self.tokenizer, self.known, self.chars = tokenizer, {}, 0

    def learn(self, parts: set[str]) -> dict[str, int]:
        new = list(parts - self.known.keys())
        if new:
            if self.chars > REMEMBERED_CHARS:
                self.known = {p: self.known[p] for p in parts & self.known.keys()}
                self.chars = sum(map(len, self.known))
            encoded = self.tokenizer.encode_batch_fast([" " + part for part in new], add_special_tokens=False)
            self.known.update(zip(new, map(len, encoded)))
            self.chars += sum(map(len, new))
        return self.known


def count_texts(texts: list[str], lengths: Lengths) -> list[int]:
    """Tokens of each text: the sum over its parts."""
    split, heads = [], []
    for text in texts:
        head, *rest = BOUNDARY.split(text)
        heads.append(head)
        split.append(rest)
    first = map(len, lengths.tokenizer.encode_batch_fast(heads, add_special_tokens=False))
    known = lengths.learn(set().union(*split))
    return [sum(map(known.__getitem__, rest)) + n for rest, n in zip(split, first)]


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024, carry: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the carried columns), ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``docs`` needs ``text``.  NULL is the empty text, with no tokens.  The
    tokenizer file must be at the same path on every executor; it must be a
    byte-level BPE.  Special strings inside texts count as the library's default
    has it.  Rows are independent of each other.
    """
    carry = docs.columns if carry is None else carry
    size = F.coalesce(F.octet_length(docs["text"]), F.lit(0)).cast("long")
    row = F.struct(F.struct(*[docs[c] for c in carry]).alias("row"), size.alias("n_bytes"))
    packed = docs.select(row.alias("row"), docs["text"].alias("text"))
    schema = packed.schema["row"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(load_tokenizer(tokenizer_path))
        for batch in batches:
            for part in by_bytes(batch, "text", 1 << 20):
                n = pa.array(count_texts(texts_of(part, "text"), lengths), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("row"), n], ["row", "n_tokens"])

    return packed.mapInArrow(count, f"row {schema}, n_tokens long") \
        .select("row.row", "row.n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
