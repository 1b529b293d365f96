import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, ids and texts, and columns named like internal ones."""
    long = "".join(f"Sentence number {i} of a very long text says something of its own. " for i in range(4000))
    rows = [
        (1, "One text.", "en", "a"),
        (1, "One text.", "en", "a"),
        (2, "One text.", None, None),
        (3, None, "en", "b"),
        (4, "", "de", "b"),
        (None, "One text.", "en", None),
        (None, None, None, None),
        (5, long, "en", "a"),
        (6, "   \n\t ", "fr", "a"),
        (7, "123 456 !!!", "es", "c"),
        (8, "One other text of the same id.", "en", "a"),
        (8, "And another one under that id.", "en", "a"),
        (9, "é漢字😀 x", "fr", "z"),
    ]
    names = "doc_id long, text string, lang string, source string"
    df = spark.createDataFrame(rows, names).selectExpr(
        "*",
        "CAST(length(text) AS BIGINT) AS n_chars",
        "1 AS id",
        "2 AS digest",
        "'x' AS `key`",
        "3 AS version",
        "4 AS row",
        "5 AS size",
        "'y' AS word",
        "6 AS fp",
        "7 AS covered",
        "8 AS score",
        "9 AS `dotted.name`",
        "map('k', 1) AS extras",
    )
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")
