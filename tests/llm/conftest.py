import random

import pytest


@pytest.fixture(scope="session")
def words():
    """A source of pseudo-random words that repeats itself."""
    source = random.Random(11)
    vocabulary = ["".join(source.choice("abcdefghij") for _ in range(source.randint(2, 9))) for _ in range(3000)]
    return lambda n, seed: [random.Random(seed * 7919 + i).choice(vocabulary) for i in range(n)]


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from ``(doc_id, text)``, with further columns whose names the operators use inside."""

    def make(rows, more="rank int, node string, label string, base string, h string, counts string, lang string, n_chars long"):
        names = [c.split()[0] for c in more.split(", ")]
        filled = [(i, t, *(None if n != "lang" else "en" for n in names)) for i, t in rows]
        return spark.createDataFrame(filled, f"doc_id long, text string, {more}")

    return make
