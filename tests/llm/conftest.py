import pytest

#: Words for made-up texts.
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


@pytest.fixture(scope="session")
def words():
    return WORDS


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, equal ids, extra columns with names of results."""
    long = " ".join(f"{WORDS[i % 20]}{i % 977}" for i in range(19_000))
    rows = [
        (1, "Plain text, nothing else in it.", "en", "s", 31, 5, "x"), (1, "Plain text, nothing else in it.", "en", "s", 31, 5, "x"),
        (1, "Another text under the same id.", "en", None, None, None, None), (2, None, None, None, None, 7, None), (3, "", "en", "s", 0, None, "y"),
        (None, "A text without an id.", "de", "s", 21, 1, None), (None, None, None, None, None, None, None), (4, long, "en", "s", len(long), 3, "z"), (5, " \t\n\n ", "en", "s", 5, 3, "z"),
        (6, "naïve café 🎉 漢字 a@b.co \x1c +1 (555) 123-4567", "fr", "s", 40, 2, "z"), (7, "x" * 20_000, "en", "s", 20_000, 2, None),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words long, spans string").coalesce(2)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
