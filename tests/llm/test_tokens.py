import zlib

import numpy as np
import pytest

from panelcast.llm import packing, token_counts
from panelcast.llm.queries import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
ODD = ["", None, " ", "a", "a  b", " a", "a ", "a \n b\n\n  c", "it's  'S we'll", "x<|endoftext|>y <|endoftext|> <|startoftext|>z",
       "é  é ́x", "a\x1cb \x1c c", "  x   x", "Σας ΣΑΣ. İ", "日本語 テスト 123 4567", "\x00   　", "a" * 3000,
       "word, " * 5000, "\r\n\t x \x0b\x0c y", "🙂 🙂🙂"]


def rows_of(documents, prose):
    return documents([(i, t) for i, t in enumerate(ODD)] + [(100 + i, prose(300 * i, i)) for i in range(20)] + [(0, "a"), (None, "b c")])


def test_counts_are_the_librarys(documents, prose):
    tokenizer = tokenizers.Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    docs = rows_of(documents, prose)
    got = token_counts.count_tokens(docs, tokenizer_path("byte_bpe_50k.json")).collect()
    assert len(got) == docs.count()
    for r in got:
        text = r["row"]["text"] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(text.encode()), n > 1024), text[:40]
    assert token_counts.count_tokens(documents([]), tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED_CHARS", 50)
    lengths = token_counts.Lengths(token_counts.load_tokenizer(tokenizer_path("byte_bpe_50k.json")))
    texts = [f"alpha beta{i} gamma{i} delta" for i in range(50)]
    want = [len(e) for e in lengths.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [token_counts.count_texts([t], lengths)[0] for t in texts] == want
    assert lengths.chars < 200


def test_packing_round_trip(documents, prose):
    path = tokenizer_path("word_bpe_49k.json")
    tokenizer = tokenizers.Tokenizer.from_file(path)
    docs = rows_of(documents, prose)
    got = packing.pack_documents(docs, path, capacity=512, with_ids=True).collect()
    whole = {}
    for r in got:
        assert 1 <= r["length"] <= 512 and zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        whole.setdefault((r["row"]["doc_id"], r["row"]["text"]), {})[r["piece"]] = r
    assert len(whole) == docs.count()
    for (_, text), pieces in whole.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        assert b"".join(pieces[k]["ids"] for k in range(len(pieces))) == ids
        assert [pieces[k]["start"] for k in range(len(pieces))] == list(range(0, len(ids) // 4, 512))
    used = {}
    for r in got:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    total = sum(r["length"] for r in got)
    assert len(used) <= 1.05 * total / 512 + 1
    assert packing.pack_documents(documents([]), path).count() == 0
    again = packing.pack_documents(docs, path, capacity=512, with_ids=True).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def brute_best_fit(lengths, capacity, open_bins):
    free, where, made = {}, [], 0
    for n in lengths:
        room = min((f for f in free.values() if f >= n), default=None)
        if room is None:
            if len(free) == open_bins:
                free.pop(next(b for b in free if free[b] == min(free.values())))
            free[made], room, made = capacity, capacity, made + 1
        bins = [b for b, f in free.items() if f == room]
        where.append((room, bins))
        b = bins[0]
        free[b] -= n
        if not free[b]:
            del free[b]
    return [room for room, _ in where], made


def test_best_fit_takes_the_fullest_bin():
    rng = np.random.default_rng(1)
    for open_bins in (1, 3, 40):
        lengths = rng.integers(1, 101, 400).tolist()
        where, offset = packing.best_fit(lengths, 100, open_bins)
        rooms, made = brute_best_fit(lengths, 100, open_bins)
        assert [100 - o for o in offset] == rooms and max(where) + 1 == made
        state, parts = {}, []
        for at in range(0, 400, 37):
            parts += packing.best_fit(lengths[at:at + 37], 100, open_bins, state)[0]
        assert parts == where


def test_words_of_any_letters_pack_as_in_the_library():
    """Letters that compose, fall apart or change with case, beside symbols."""
    words = packing.WordIds(token_counts.load_tokenizer(tokenizer_path("word_bpe_49k.json")))
    letters = [c for c in map(chr, [*range(0x80, 0x1400, 3), *range(0x958, 0x960), *range(0xFB00, 0xFB50)]) if c.isprintable()]
    texts = [f"ab{c}cd. {c}{c}** x{c} {c}!$ A{c}%" for c in letters]
    wanted = [e.ids + [1] for e in words.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert [list(memoryview(ids).cast("I")) for ids in packing.document_ids([t.encode() for t in texts], words, 1)] == wanted
