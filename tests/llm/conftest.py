import random

import pytest

WORDS = "the of and le la tree house river stone cloud lamp paper glass wind road king".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ly", "ing"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, copies, near copies, repeated rows, shared passages and an extra column."""
    base, passage = prose(1, 300), prose(2, 120)
    rows = [
        (10, base, "a"), (4, base, "a"), (7, base.replace("river", "sea", 2), "b"), (3, None, None), (8, "", "b"),
        (9, " \n\t ", None), (None, base, "a"), (None, prose(3, 80), "c"), (11, "one two", "c"), (12, "ONE Two", "c"),
        (20, prose(4, 60) + " " + passage, "a"), (21, prose(5, 70) + "\n" + passage + " " + prose(6, 30), "b"),
        (22, passage, "b"), (30, prose(7, 200), "d"), (30, prose(7, 200), "d"), (31, "ab " * 900, "d"),
        (32, "é" * 700 + " " + "x" * 700, "e"), (33, "x" * 450, "e"), (34, prose(8, 6000), "a"), (35, prose(8, 6000)[200:], "a"),
        (36, "a  b <|endoftext|> c", "a"),
    ]
    return spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, source string, spans string")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, spans string")
