import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, row string, key string, id long"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from ``(id, text[, lang, source])``; further columns have names that operators use inside."""
    def make(rows):
        full = [(*r, *(None,) * (4 - len(r)), 1, 2, "x", "y", 3) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


def words(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def prose():
    return lambda n, seed, vocabulary=400: " ".join(words(n, seed, vocabulary))
