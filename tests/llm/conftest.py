import random

import pytest


@pytest.fixture(scope="session")
def lorem():
    """Deterministic texts of invented words."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(400)]

    def make(n, seed):
        r = random.Random(seed)
        return " ".join(r.choice(words) for _ in range(n))

    return make


DOCS = "doc_id long, text string, source string, _mix_id int, h string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents with clashing extra columns."""

    def make(rows):
        return spark.createDataFrame([(i, t, s, 7, "x") for i, t, s in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(docs_of, lorem):
    """Nulls, empty and very long texts, repeated rows and ids."""
    same = lorem(40, 1)
    return docs_of([
        (None, None, None), (1, None, "a"), (2, "", "a"), (3, "   \n\t", None), (4, same, "b"), (4, same, "b"), (4, lorem(30, 2), "b"),
        (None, same, "a"), (5, lorem(30_000, 3), "a"), (6, "x" * 50_000, "b"), (7, "é\U0001F600 \n\n", "c"), (8, same, None),
    ])
