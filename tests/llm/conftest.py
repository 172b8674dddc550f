import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
EXTRA = "fp long, key string, row string, found string, host string, k long, id long, text_hash string, size long"


def frame(spark, rows):
    """Rows (doc_id, text, lang, source) as documents with more columns."""
    full = [(i, t, g, s, None if t is None else len(t), 1, "x", "y", None, "h", 2, 3, "t", 4) for i, t, g, s in rows]
    return spark.createDataFrame(full, SCHEMA + ", " + EXTRA)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, ids that occur twice."""
    long = " ".join(f"word{i % 977} the of" for i in range(12_000))
    rows = [
        (1, "the cat of the house and a dog in the garden of it", "en", "a"), (1, "the cat of the house and a dog in the garden of it", "en", "a"),
        (2, None, "en", "a"), (3, "", None, None), (None, "und der Hund ist nicht in dem Haus von der Katze", "de", None),
        (4, long, "en", "b"), (5, " \t\n ", "de", "b"), (6, "12 34 56", None, "b"), (6, "la maison de le chien et une", "fr", "c"),
        (7, "x" * 30_000, None, "c"), (None, None, None, None), (8, "ünïcode ▁ text\n\n<s> 中文", "fr", "c"),
    ]
    return frame(spark, rows)


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def documents(spark):
    from tests.conftest import SF0001

    return spark.read.parquet(f"{SF0001}/documents.parquet")
