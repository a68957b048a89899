"""Shared fixtures of the training-data operators' tests."""

import pytest


@pytest.fixture
def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows and a clashing extra column."""
    rows = [
        (1, "one two three four five six seven eight", "a", 1, "x"),
        (1, "one two three four five six seven eight", "a", 1, "x"),
        (2, None, "a", 2, "y"),
        (3, "", None, 3, None),
        (4, "word " * 30_000 + "end", "b", 4, "z"),
        (5, "ONE two three four five six seven eight", "b", None, "x"),
        (6, "  \n\t ", "c", 6, "x"),
        (7, "one", "c", 7, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n long, size string")


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, n long, size string")
