import pytest


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Rows with nulls in every column, empty and long texts, ties, repeated rows and clashing columns."""
    long = " ".join(f"wort{i % 977} und {i}" for i in range(30_000))
    plain = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix a jug of bad potion today"
    rows = [
        (1, plain, "en", "a", 10, 7, "x"), (2, plain, "en", "a", 10, 7, "x"), (2, plain, "en", "a", 10, 7, "x"),
        (3, None, "en", None, None, None, None), (4, "", None, "b", 0, 1, "y"), (None, plain, "en", "a", 1, 2, "z"),
        (None, None, None, None, None, None, None), (5, long, "de", "b", len(long), 3, "k"),
        (6, " \n\t \n", "en", "c", 5, 4, "k"), (7, "Grüße 東京 🙂 token: abc", "de", "c", 5, 4, "k"),
        (9_007_199_254_740_993, plain + " again and again", "en", "c", 5, 4, "k"),
    ]
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, key string"
    return spark.createDataFrame(rows, columns)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
