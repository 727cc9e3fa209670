import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls in every column, empty and blank texts, ties,
    repeated rows, and extra columns whose names operators use inside."""
    prose = " ".join(f"word{i % 37} thing{i % 11}" for i in range(60))
    rows = [
        (1, prose, "en", "a", 3), (1, prose, "en", "a", 3),            # a repeated row
        (2, prose, "fr", "a", 3), (3, prose.upper(), None, "b", None),  # equal and case-equal texts
        (4, None, "en", "b", 0), (5, "", "fr", None, 0), (6, " \t\n\r ", None, None, 2),
        (7, "one two", "en", "c", 7), (None, prose, "en", None, 3), (None, None, None, None, None),
        (8, "1234 5678 !!", "fr", "c", 12), (9, "ünï cödé — 文字 \U0001f600", "fr", "c", 10),
        (10, ("long " * 20_000).strip(), "en", "a", 99_999), (11, "x" * 300_000, "en", "a", 300_000),
        (12, "first line\nsecond line here\nfirst line", "en", "a", 10), (13, "second line here\n\nother", "fr", "b", 10),
        (12, "another text of an id that comes twice", "en", "a", 10),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = {c: df["n_chars"] for c in ("content", "sid", "row", "label", "copies", "h", "slice", "start", "line", "tokens",
                                         "score", "kept", "digest", "n", "__x", "words", "size")}
    return df.withColumns(extra).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
