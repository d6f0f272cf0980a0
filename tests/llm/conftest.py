import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, size string, matches string, n string, block string"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefghij", k=r.randint(2, 7))) for _ in range(n))


def edited(text: str, seed: int, share: float) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choices("klmnop", k=5)) if r.random() < share else w for w in text.split())


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, near and exact copies."""
    long, base = prose(1, 20_000), prose(2, 300)
    texts = [
        (0, None, "a"), (1, "", "a"), (2, " \t\n ", None), (3, "one two three", "b"), (4, "one two three", "b"),
        (5, long, "a"), (6, long + " tail", "a"), (7, base, "a"), (7, base, "a"), (8, base.upper(), None),
        *[(10 + i, edited(base, i, 0.01), "a") for i in range(12)], *[(30 + i, edited(base, 50 + i, 0.08), "c") for i in range(12)],
        (50, "x" * 49, "b"), (51, "y" * 50, "b"), (52, "y" * 51, ""), (53, base[:400] + prose(3, 50), "c"), (54, "ééé ñ\u00a0ß " * 20, "é"),
        (None, base, "a"), (None, None, None), (60, "be " * 200, "b"), (61, "be " * 150, "b"), (-4, "five words are in here", "b"),
    ]
    return [(i, t, "en", s, len(t or ""), "x", "x", "x", "x", "x") for i, t, s in texts]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)
