"""Small tables with everything that goes wrong."""

import os
import sys

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))  # for the Python workers

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} Other{i % 31}" for i in range(40_000))
# Nulls, empty and blank texts, one very long text, exact and near copies, ties and repeated rows.
AWKWARD = [
    (1, "the cat sat on the mat and looked at the other cat", "en", "a", 50),
    (2, "the cat sat on the mat and looked at the other cat", "en", "a", 50),
    (2, "the cat sat on the mat and looked at the other cat", "en", "a", 50),
    (3, "", "en", None, 0),
    (4, None, None, "b", None),
    (5, " \t\n ", "en", "b", 4),
    (None, "a text without an id", "en", "a", 20),
    (None, None, None, None, None),
    (7, LONG, "en", "c", len(LONG)),
    (8, LONG + " end", "en", "c", len(LONG) + 4),
    (9, "Ünïcödé 漢字 text　with  runs   of spaces \n and <|endoftext|> inside ▁ it", "xx", "c", 70),
    (10, "x", "en", "d", 1),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(AWKWARD, DOCUMENTS)


@pytest.fixture
def odd(docs):
    """The same with extra columns whose names the operators use themselves."""
    names = ["size", "score", "fp", "part", "ids", "target", "host", "word", "chunk", "label"]
    return docs.withColumns({n: F.lit(f"own {n}") for n in names})


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


def rows_of(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
