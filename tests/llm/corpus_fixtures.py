import pytest

LONG = "lorem ipsum dolor " * 20_000


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, a clashing extra column."""
    rows = [(1, "one two three four five six", "en", "s", 27, "x"), (2, None, None, None, None, None), (3, "", "en", "s", 0, "y"),
            (4, LONG, "en", "s", len(LONG), "z"), (5, "one two three four five six", None, "s", 27, "x"),
            (5, "one two three four five six", None, "s", 27, "x"), (None, "a text without an id, seven words", "en", None, 3, None),
            (6, " \n\t ", "en", "s", 4, "q"), (7, "*** $$$", "en", "s", 7, "q"), (8, "short", "en", "s", 5, "q")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
