import random

import pytest

#: An extra column for every name that an operator uses or returns itself.
CLASHES = ["n_words", "kept", "component_id", "rep", "label", "labels", "rest", "z", "dk", "tie", "n_tokens", "score", "k1", "ids", "part", "n", "turns", "unit", "row", "words", "own"]

WORDS = "the and of license apache mit general public quick brown fox über Straße naïve ÉCOLE 你好 x1 don't e.g. end. (so) # | <tag> été".split(" ")


def text_of(rng: random.Random, n: int) -> str:
    return "".join(rng.choice(WORDS) + rng.choice([" ", " ", " ", "\n", "  ", "\t", ", "]) for _ in range(n))


def edge_texts() -> list[tuple[int | None, str | None]]:
    """(id, text): nulls, empty, blanks, one word, copies, near copies, shared passages, repeats, ids that occur twice, a very long text."""
    rng = random.Random(5)
    base, passage = text_of(rng, 120), text_of(rng, 60)
    changed = base.replace("fox", "cat", 1)
    out = [(1, base), (2, base), (3, changed), (4, base + " tail"), (5, None), (6, ""), (7, " \n\t "), (8, "word"), (9, "word"), (10, "two words"), (None, base), (None, None),
           (11, text_of(rng, 40) + passage + text_of(rng, 30)), (12, passage), (13, "é" * 7 + passage + "x"), (14, (text_of(rng, 12)) * 9), (15, "same id, first text " * 3), (15, text_of(rng, 50)),
           (16, text_of(rng, 25)), (16, text_of(rng, 25)), (17, "a" * 400), (18, "<|endoftext|> MIT License, and the APACHE licence\x00\x7f Version 2.0"), (19, "1234 !!! ??? 5"), (-3, base), (20, text_of(rng, 9000))]
    rng2 = random.Random(8)
    out += [(100 + k, text_of(rng2, rng2.randint(1, 60))) for k in range(40)]
    return out + [(1, base)]


@pytest.fixture(scope="session")
def edge_rows():
    return edge_texts()


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """documents with every edge case, a null in each column and extra columns that clash."""
    clash = ", ".join(f"`{c}` string" for c in CLASHES)
    rows = [(i, t, None if k % 7 == 0 else ("en", "fr")[k % 2], None if k % 5 == 0 else f"s{k % 3}", None if t is None else len(t), *["x"] * len(CLASHES)) for k, (i, t) in enumerate(edge_rows)]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {clash}").repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
