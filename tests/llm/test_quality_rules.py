import math
import re

import pytest

from panelcast.llm import quality_rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + s for i, w in enumerate(windows) if windows.count(w) > 1 for s in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts(documents, prose):
    texts = [None, "", " \t", "a", "a b c", "a b c a b c", "a a a a", "x\ny\nx\nx\n\n \n \n", "é # ü%% 日本 語 <b>", "a b c d a b", prose(200, 1, 6), prose(3000, 2, 30),
             "r\r\nr\r\nr", "line one\nline  one\nline one"]
    got = {r["given"]["doc_id"]: r for r in quality_rules.measure(documents(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute(text), text


def test_exact_bound():
    def tail(k, n, p):
        return sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
    for n, k, p, level in ((100, 0, 0.05, 0.05), (100, 0, 0.01, 0.05), (1000, 5, 0.02, 0.001), (1000, 3, 0.02, 0.001), (10, 1, 0.5, 0.02), (5, 5, 0.5, 1.0)):
        assert quality_rules.upper_tail_ok(k, n, p, level) == (k < n * p and tail(k, n, p) <= level)


@pytest.fixture(scope="module")
def judged(documents, prose, spark):
    clean = [(i, prose(100, i, 3000), ("en", None)[i % 2]) for i in range(6000)]
    junk = [(10_000 + i, prose(100, i, 3000) + " #%" * 60, "en") for i in range(100)]
    few = [(20_000 + i, prose(100, i, 3000) + " #%" * 60, "xx") for i in range(20)]
    docs = documents(clean + junk + few + [(30_000, None, "en"), (30_001, "a b " * 100, "en")])
    labels = spark.createDataFrame([(i, 1) for i in range(6000)] + [(10_000 + i, 0) for i in range(50)] + [(None, 1), (3, None)], "doc_id long, quality int")
    return {r["row"]["doc_id"]: r for r in quality_rules.apply_rules(docs, labels).collect()}


def test_junk_goes_and_clean_stays(judged):
    clean = [judged[i]["kept"] for i in range(6000)]
    assert sum(clean) >= 0.98 * len(clean)
    assert not any(judged[10_000 + i]["kept"] for i in range(100))
    assert "symbols" in judged[10_000]["failed_rules"]


def test_small_strata_certify_nothing(judged):
    assert all(judged[20_000 + i]["kept"] for i in range(20))
    assert judged[30_000]["base_failed"] and judged[30_001]["base_failed"] and not judged[30_001]["kept"]


def test_without_labels_or_rows(documents, prose, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality_rules.apply_rules(documents([(1, prose(80, 1) + " #" * 80), (1, "")]), none).collect()
    assert sorted(r["kept"] for r in rows) == [False, True]
    assert quality_rules.apply_rules(documents([]), none).count() == 0


def test_a_few_hundred_labels_certify(documents, prose, spark):
    langs = ("en", "de", "fr", "it")
    clean = [(i, prose(100, i, 3000), langs[i % 4]) for i in range(4 * 240)]  # 217 suffice for 2 % in four strata
    junk = [(10_000 + i, prose(100, i, 3000) + " #%" * 60, langs[i % 4]) for i in range(40)]
    labels = spark.createDataFrame([(i, 1) for i in range(4 * 240)], "doc_id long, quality int")
    judged = {r["row"]["doc_id"]: r for r in quality_rules.apply_rules(documents(clean + junk), labels).collect()}
    assert not any(judged[10_000 + i]["kept"] for i in range(40))
    assert all(sum(judged[i]["kept"] for i in range(k, 960, 4)) >= 0.98 * 240 for k in range(4))


def test_chain_counts_what_all_rules_reject(documents, prose, spark):
    rules = {"symbols": ("n_symbols", "n_words", (0.1, 0.5)), "long_words": ("word_chars", "n_words", (5.0, 20.0))}
    assert quality_rules.chain(rules) == [("symbols", 0.5), ("long_words", 20.0), ("symbols", 0.1), ("long_words", 5.0)]
    rows = [("s", n_symbols, chars, 100, good) for n_symbols, chars, good in
            ((0, 400, True), (60, 400, True), (60, 2500, True), (20, 2500, True), (20, 400, True), (0, 600, True), (90, 9000, False))]
    stats = spark.createDataFrame(rows, "stratum string, n_symbols long, word_chars long, n_words long, good boolean")
    got = {(r["rule"], r["cutoff"]): (r["n_good"], r["n_rejected"]) for r in quality_rules.certify(stats, rules).collect()}
    assert [got[step] for step in quality_rules.chain(rules)] == [(6, 2), (6, 3), (6, 4), (6, 5)]
