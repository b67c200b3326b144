import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns with clashing names."""
    rows = [
        (1, "one two three four five six", "en", 1, 2, "x"),
        (1, "one two three four five six", "en", 1, 2, "x"),
        (2, "one two three four five six", None, 1, 2, None),
        (None, None, None, None, None, None),
        (3, "", "en", 0, 0, "x"),
        (4, None, "en", 0, 0, "x"),
        (None, "word", None, None, None, None),
        (5, "long words here " * 20_000, "en", 1, 2, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n long, row long, node string")
