from __future__ import annotations

import random

import pytest

WORDS = "the of and a in to is was he for it with as his on be at by i this had not are but from or".split()


def text(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


@pytest.fixture
def documents(spark):
    """Odd rows of every kind: nulls, empty, blank, one word, long, copies, ties, repeated rows."""
    long = text(1, 3000)
    rows = [
        (0, text(2, 120), "en", "a", 1, "k0"),
        (1, text(2, 120), "en", "b", 1, "k1"),
        (2, text(2, 119) + " other", None, "a", 1, "k2"),
        (3, None, "en", None, 1, None),
        (4, "", "de", "a", 1, "k4"),
        (5, " \n\t ", None, "b", 1, "k5"),
        (6, "one", "de", "c", None, "k6"),
        (7, long, "en", "a", 1, "k7"),
        (8, "x" * 5000, "en", "b", 1, "k8"),
        (9, text(3, 40) + "\n" + text(2, 30) + "\r\n" + text(4, 20), "en", "c", 1, "k9"),
        (10, "Straße ÉTÉ 日本語 😀 " * 12, "de", "c", 1, "k10"),
        (10, "Straße ÉTÉ 日本語 😀 " * 12, "de", "c", 1, "k10"),
        (11, "12 34 56 78 90", None, "", 1, "k11"),
        (None, text(2, 120), "en", "a", 1, "none"),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, id string"
    ).repartition(3, "source")


@pytest.fixture
def empty(documents):
    return documents.limit(0)
