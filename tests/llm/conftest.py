import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, cls string, size string, rate string, "
          "_id string, score string, key string, block string, `odd.name` string")


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(2, 8))) for _ in range(400)]


@pytest.fixture(scope="session")
def sentence(words):
    def make(n: int, seed: int) -> str:
        rng = random.Random(seed)
        return " ".join(rng.choice(words) for _ in range(n))
    return make


def _row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, len(text or ""), "x", "x", "x", "x", "x", "x", "x", "x")


@pytest.fixture(scope="session")
def table(spark):
    def make(rows):
        return spark.createDataFrame([_row(*r) for r in rows], SCHEMA)
    return make


@pytest.fixture(scope="session")
def odd(table, sentence):
    """Nulls in every column, empty, blank and very long texts, repeated rows, clashing extra columns."""
    base = sentence(60, 1)
    loud = "".join(c.upper() if c.isascii() else c for c in base)
    return table([(1, base), (2, loud), (2, loud), (3, None), (4, ""), (5, " \n\t "), (None, base), (None, None, None, None),
                  (6, sentence(60, 2), None, None), (7, sentence(30_000, 3)), (8, "one two"), (9, "ONE  two"), (10, "🙂 é\x00ü " * 30),
                  (11, sentence(60, 4) + "\n" + sentence(60, 4)), (12, "word " * 500)])


@pytest.fixture(scope="session")
def empty(table):
    return table([])
