from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and an extra column with a clashing name."""
    long = " ".join(f"word{i % 977} tail{i % 31}" for i in range(60_000))
    rows = [
        (1, None, "en", "a", None),
        (2, "", "en", None, 0),
        (3, "  \n\n ", None, "a", 5),
        (4, long, "en", "a", len(long)),
        (5, "one two", "en", "b", 7),
        (None, "one two three four five six\nseven\neight nine", "en", "b", 7),
        (6, "same line\nother line\nthird line\nlast", "en", "b", 1),
        (6, "same line\nother line\nthird line\nlast", "en", "b", 1),
        (7, "same line\nother line\nthird line\nelse", "en", "b", 1),
    ]
    return spark.createDataFrame([(*r, "x") for r in rows], f"{DOCS}, score string")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
