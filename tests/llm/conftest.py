"""Documents that operators must take: nulls, empty and very long texts, repeated rows, clashing column names."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, row string, h int, rep int, words string, key string"
LONG = "lorem ipsum dolor sit amet " * 40_000


@pytest.fixture(scope="session")
def awkward(spark):
    texts = [
        (1, "the quick brown fox jumps over the lazy dog and runs far away"),
        (1, "the quick brown fox jumps over the lazy dog and runs far away"),
        (2, "the quick brown fox jumps over the lazy dog and runs far away"),
        (3, None),
        (4, ""),
        (None, "a text without an id, idiot"),
        (None, None),
        (5, LONG),
        (6, "12345 !!! 678"),
        (7, "señor\x00 naïve \U0001f600 日本語 <|endoftext|> tail"),
        (9_007_199_254_740_993, "one word"),
    ]
    rows = [(i, t, None, None, None, "s", "r", 1, 2, "w", "k") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_documents(awkward):
    return awkward.limit(0)
