"""Rows and fixtures the tests of the text operators share."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def small():
    connection = duckdb.connect()
    for file in os.listdir(SMALL):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SMALL}/{file}'")
    return connection


@pytest.fixture(scope="session")
def texts(small):
    return dict(small.execute("SELECT doc_id, text FROM documents").fetchall())


LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(40_000))

#: Nulls in every column, empty and very long texts, repeated rows, ties, and texts without words or letters.
ODD = [
    (1, "One two three four five.\nSix seven eight nine.", "en", "a", 40),
    (1, "One two three four five.\nSix seven eight nine.", "en", "a", 40),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (3, "   \n\t\n", "de", "a", 6),
    (None, "One two three four five.\nSix seven eight nine.", "en", None, 1),
    (None, None, None, None, None),
    (4, LONG, "en", "a", len(LONG)),
    (5, "12 34 !! ..", "en", "a", 11),
    (6, "Ünï é́ \U0001d400\U0001d401 İ x\x00y <s>[INST]", "de", "a", 5),
    (7, "a", "en", "a", 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with columns whose names operators use themselves."""
    rows = [(*row, "clash", 1.5, 7) for row in ODD]
    return spark.createDataFrame(rows, DOCUMENTS + ", id string, score double, fingerprint int")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
