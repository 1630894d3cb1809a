"""Fixtures for the corpus operators."""

from __future__ import annotations

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or longer rows."""

    def make(rows):
        full = [
            (r[0], r[1], *(r[2:] or ("en", "a", None if r[1] is None else len(r[1])))) for r in rows
        ]
        return spark.createDataFrame(full, DOCUMENT)

    return make


@pytest.fixture(scope="session")
def prose():
    """A maker of texts of made-up words that hardly repeat."""
    import random

    def make(seed: int, n: int) -> str:
        r = random.Random(seed)
        return " ".join("".join(r.choices("abcdefghij", k=r.randint(2, 8))) for _ in range(n))

    return make
