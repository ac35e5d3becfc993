from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, word string, row int, h int, key int"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(n))


def corpus(n: int = 240, seed: int = 3) -> list[tuple]:
    """Plain texts of two languages, one source with a third of them."""
    rng = random.Random(seed)
    return [
        (i, sentence(rng, rng.randint(60, 120)) + ".", ("en", "de")[i % 2], "s0" if i % 3 else f"s{i % 5}", 1, 0, "w", 0, 0, 0)
        for i in range(n)
    ]


# Nulls in every column, empty and blank texts, ties, repeated rows.
HARD = [
    (None, None, None, None, None, None, None, None, None, None),
    (1001, None, "en", None, None, None, None, None, None, None),
    (1002, "", None, "s0", 0, 0, "", 0, 0, 0),
    (1003, " \n\t ", "en", "s0", 0, 0, "", 0, 0, 0),
    (1004, "one", "en", "s0", 0, 0, "", 0, 0, 0),
    (1004, "one", "en", "s0", 0, 0, "", 0, 0, 0),
    (None, "one two three", "en", "s0", 0, 0, "", 0, 0, 0),
    (1005, "x" * 300_000, "en", "s0", 0, 0, "", 0, 0, 0),
    (1006, "lorem ipsum " * 60_000, "en", "s0", 0, 0, "", 0, 0, 0),
    (1007, "é漢🙂́ it's I'LL 12³  <|endoftext|>\x1c\x85", "fr", "s1", 0, 0, "", 0, 0, 0),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus() + HARD, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
