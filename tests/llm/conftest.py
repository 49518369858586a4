import random

import pytest

SYLLABLES = ["an", "the", "on", "er", "re", "st", "ing", "ou", "ti", "wh", "ha", "ed", "ly", "or", "ble"]


@pytest.fixture()
def make_docs(spark):
    """Rows (doc_id, text) to a documents table, with an extra column whose name an operator might use."""

    def make(rows, **extra):
        data = [(i, t, None, "src", len(t) if t else 0, "x") for i, t in rows]
        return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, score string").repartition(3)

    return make


@pytest.fixture()
def prose():
    """``prose(seed, n)``: n invented words."""

    def write(seed, n):
        r = random.Random(seed)
        return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n))

    return write
