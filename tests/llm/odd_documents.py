import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, origin string, k1 string, n_words string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with extra columns whose names operators use themselves."""

    def make(rows):
        full = [(i, t, lang, source, None if t is None else len(t), "x", "y", "z") for i, t, lang, source in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog.\nIt ran away 12 times.", "en", "a"),
        (1, "The quick brown fox jumps over the lazy dog.\nIt ran away 12 times.", "en", "a"),
        (2, None, None, None), (None, None, None, None), (3, "", "en", ""), (4, " \n\t", "de", "b"),
        (None, "ein kleiner Satz ohne Nummer", "de", "b"), (5, long, "en", "a"), (6, "1234 !!", None, "c"), (7, "a b", "fr", None),
    ]
    return make_docs(rows)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
