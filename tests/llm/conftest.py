import pytest

LONG = "alpha beta gamma delta " * 3000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, repeated rows, and columns with the names used inside."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog again and again", "en", "a", 5),
        (1, "The quick brown fox jumps over the lazy dog again and again", "en", "a", 5),
        (2, "", "en", "a", 0),
        (3, None, None, None, None),
        (None, "a text without an id, card 4465758382889437 4465758382889437 here", "en", "b", 1),
        (4, " \t\n ", "de", "b", 3),
        (5, LONG, "en", "b", len(LONG)),
        (6, "x", "fr", None, 1),
        (7, "one\ntwo\nthree\nfour", "en", "a", 18),
        (8, "zero\none\ntwo\nthree\nfive", "en", "a", 23),
        (9, "12345 !!!  ", "de", "c", 11),
        (10, "Café \U0001f600 naïve <|endoftext|>x mail someone@example.com now", "fr", "c", 9),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    clash = ["key", "row", "body", "k", "words", "h", "n", "score", "covered", "tail", "fp", "root", "kept", "item"]
    return df.selectExpr("*", *[f"'z' AS `{c}`" for c in clash])


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
