import random

import pytest
from llm_samples import words

#: Columns whose names the operators use themselves.
CLASHING = ("n_words", "score", "label", "part", "batch", "digest", "component", "length", "host", "row", "rank", "place")


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): nulls, empty, blank and very long texts, ties and repeated rows."""
    rng = random.Random(5)
    base = words(rng, 120)
    rows = [
        (1, base), (2, base), (2, base), (3, None), (4, ""), (5, " \n\t "), (None, base), (None, None), (6, "one"), (6, "one two three"),
        (7, words(rng, 30_000)), (8, "naïve Ωmega 你好 🙂  <|endoftext|> a<|startoftext|>b\r\nx"), (9, "a" * 3000), (10, "a b c d e f g h " * 40),
        (11, "x\x1cy\x85z\u3000 v \x0b\x0c"),
    ]
    return rows + [(100 + i, words(rng, rng.randrange(1, 200))) for i in range(40)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["clash"] * len(CLASHING)) for r in odd_rows], schema).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")
