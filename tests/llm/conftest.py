import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
for folder in (ROOT, os.path.join(ROOT, "tests")):
    if folder not in sys.path:
        sys.path.insert(0, folder)

# Nulls, empties, ties, repeated rows, a long text, and columns whose names clash with the operators'.
LONG = " ".join(f"w{i % 4000}" for i in range(30_000))
ODD = [
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "s", "x", 7),
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "s", "x", 7),
    (2, None, None, None, None, None),
    (None, "the quick brown fox jumps over the lazy dog again and again", "en", None, "y", 1),
    (None, None, None, None, None, None),
    (3, "", "fr", "s", "", 0),
    (4, " \t\n ", "de", "s", "z", 0),
    (5, "!!! 12 ???", "de", "s", "z", 0),
    (6, LONG, "en", "s", "z", 0),
    (7, "a@b.co b", None, "s", "z", 0),
]
SCHEMA = "doc_id long, text string, lang string, source string, score string, start int"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
