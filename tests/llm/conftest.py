import pytest


@pytest.fixture
def documents(spark):
    """Rows of documents from (doc_id, text); a column more, with a name the operators use."""
    def make(rows, source="src"):
        full = [(i, t, "en", source, len(t or ""), "own") for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score string")
    return make


ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one"), (6, "x" * 50_000), (7, "the of and " * 3000), (7, "the of and " * 3000),
       (None, "no key here at all, none whatever"), (8, "a@b.example.com 10.0.0.1 é ß 𝄞")]


@pytest.fixture
def odd(documents):
    """Nulls, empty and very long texts, ties, and repeated rows."""
    return documents(ODD)


@pytest.fixture
def empty(documents):
    return documents([(1, "x")]).limit(0)
