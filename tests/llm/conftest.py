import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string, cluster int"


def _prose(i: int, n: int = 60) -> str:
    return " ".join(f"w{(i * 31 + j * j) % 97}x{(i + j) % 11}" for j in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing columns."""
    rows = [
        (1, _prose(1), "en", "a", 5, 0.5, "x", 1),
        (1, _prose(1), "en", "a", 5, 0.5, "x", 1),
        (2, _prose(1), "en", "a", 5, None, None, None),
        (3, _prose(1) + " tail", "fr", None, None, 0.1, "y", 2),
        (4, None, None, None, None, None, None, None),
        (5, "", "en", "b", 0, None, None, None),
        (6, " \t\n ", "en", "b", 4, None, None, None),
        (7, "123 %%% 456", "en", "b", 4, None, None, None),
        (8, "one two", None, "b", 7, None, None, None),
        (9, "ONE  two\n", "fr", "b", 7, None, None, None),
        (10, _prose(5, 40_000), "fr", "b", 9, None, None, None),
        (None, _prose(9), "en", "c", 9, None, None, None),
        (11, "Été K İ <|endoftext|> \x00", "fr", "c", 9, None, None, None),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 0, 1), (3, 1, None), (5, None, 1), (8, 0, 0), (8, 0, 1), (None, 1, 1), (99, 1, 1)],
        "doc_id bigint, quality int, toxic int",
    )


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
