import pytest

ODD = [
    (1, "Alpha beta gamma. Delta epsilon!\nSecond line here.", "x"),
    (2, None, "x"),
    (3, "", None),
    (4, "Alpha beta gamma. Delta epsilon!\nSecond line here.", "x"),
    (4, "a row with the same id, but a text of its own", "y"),
    (None, "no id at all, though a text of some length stands here", "z"),
    (7, "naïve café <|endoftext|> 日本語 \U0001f923 it's  fine\t\ttabs \n\n\n end ", "x"),
    (8, "word " * 3000 + "z" * 5000, "long"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids and texts, empty and long texts, repeated rows, and columns whose names clash with results."""
    rows = [(i, t, s, 5, "fp", 1.5) for i, t, s in ODD]
    return spark.createDataFrame([*rows, rows[0]], "doc_id long, text string, source string, n_tokens int, fp string, score double")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
