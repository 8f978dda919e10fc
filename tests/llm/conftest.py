import random

import pytest

CLASHES = ["id", "key", "size", "row", "text_no", "component_id", "group", "score", "ids", "rank", "_key", "_part"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with columns whose names the operators use inside."""

    def make(rows):
        data = [(i, t, s, *range(len(CLASHES))) for i, t, s in rows]
        cols = ", ".join(f"`{c}` int" for c in CLASHES)
        return spark.createDataFrame(data, f"doc_id long, text string, source string, {cols}").repartition(3)

    return make


@pytest.fixture(scope="session")
def prose():
    """Random sentences, the same on every run."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdeghilmnorstué") for _ in range(rng.randint(2, 9))) for _ in range(400)]

    def text(n, seed):
        r = random.Random(seed)
        return " ".join(r.choice(words) for _ in range(n))

    return text
