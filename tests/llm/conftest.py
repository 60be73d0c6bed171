import pytest

LONG = "lorem ipsum dolor " * 20_000


@pytest.fixture
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, and columns that clash with results."""
    rows = [(1, "", "x", 1), (2, None, None, None), (None, "some words here", "y", 2), (3, " \n\t ", "z", 3), (4, LONG, "w", 4), (5, "same text again", "v", 5), (5, "same text again", "v", 5), (6, "éà 漢字 naïve 🎈", "u", 6)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, n_words long")


@pytest.fixture
def none(odd):
    return odd.where("doc_id > 99")
