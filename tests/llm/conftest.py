import pytest

LONG = "word " * 3000 + "end"
#: Rows that every operator must take: nulls anywhere, empty, blank and long texts, ties, repeats, a clashing column.
EDGES = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank.", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog near the river bank.", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "b"),
    (4, " \t\n\x0b ", "fr", "b"),
    (5, LONG, "en", "c"),
    (None, "a text without an id", "en", "c"),
    (6, "漢字 😀 émoji éé <s> token = 'abcdef123'\nline\nline", "xx", "d"),
    (7, "x" * 5000, "en", "d"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame([(*r, 1) for r in EDGES], "doc_id long, text string, lang string, source string, key int")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
