import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, kept string, shard string, h string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null and empty texts, ids, languages and sources, repeated rows, clashing column names, one long text."""
    long = "alpha beta gamma delta " * 3000
    rows = [
        (1, "the cat sat on the mat and the dog ran home", "en", "a", 1, "x", "x", "x", "x"),
        (1, "the cat sat on the mat and the dog ran home", "en", "a", 1, "x", "x", "x", "x"),
        (2, "the cat sat on the mat and the dog ran home", "en", None, 1, "x", "x", "x", "x"),
        (3, None, "en", "b", None, None, None, None, None),
        (4, "", "en", "b", 0, None, None, None, None),
        (5, " \t\n ", None, "b", 4, None, None, None, None),
        (6, "1234 5678 !!", "en", "b", 4, None, None, None, None),
        (None, "le chat dort sur la chaise près de la fenêtre", "fr", None, 1, None, None, None, None),
        (None, "le chat dort sur la chaise près de la fenêtre", "fr", None, 1, None, None, None, None),
        (None, None, None, None, None, None, None, None, None),
        (7, long, "en", "c", len(long), None, None, None, None),
        (8, "un deux trois quatre cinq six sept", "fr", "c", 1, None, None, None, None),
        (9, "one\ntwo\none\n\n \ntwo", "en", "c", 1, None, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
