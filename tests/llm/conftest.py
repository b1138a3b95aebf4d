import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "size long, key string, row long, kept boolean, text_sha256 string, list string, score int")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with columns of names that the operators use themselves."""

    def make(rows):
        full = [(i, t, lang, source, None if t is None else len(t), 1, "k", 2, True, "x", "y", 3) for i, t, lang, source in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def prose():
    """Invented sentences: prose(seed, words)."""

    def make(seed, words, vocabulary=400):
        rng = random.Random(seed)
        pool = ["".join(random.Random(k).choice(["ba", "to", "ri", "ne", "su", "lam", "ork"]) for _ in range(1 + k % 4)) for k in range(vocabulary)]
        return " ".join(rng.choice(pool) for _ in range(words))

    return make
