from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A function: a documents table of (id, text) or (id, text, source) rows."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


def prose(seed: int, n: int) -> list[str]:
    """Words that hardly repeat."""
    chance = random.Random(seed)
    return ["".join(chance.choices("abcdefghij", k=5)) for _ in range(n)]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeats and clashing extra columns."""
    long_text = " ".join(prose(1, 30_000))
    shared = " ".join(prose(2, 80))
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \t\n", None), (None, "no id " + shared, "b"),
        (4, long_text, "b"), (5, long_text, "b"), (6, shared, None), (6, shared, None), (6, shared, None),
        (7, shared.upper() + " tail", "c"), (8, "four words are here", "c"), (None, None, None),
        (9, "Ünïcode \U0001f600 text\x1cwith\xa0odd spaces " + shared, "c"), (10, "x" * 50_000, "a"),
    ]
    clashing = ("key", "hash", "size", "n", "pick", "label", "runs", "k", "i", "words", "score", "item", "target")
    full = [(*r, *["clash"] * len(clashing)) for r in rows]
    schema = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in clashing)
    return spark.createDataFrame(full, schema)
