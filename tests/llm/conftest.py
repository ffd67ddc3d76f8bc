import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and ties, with an extra column."""
    long = " ".join(f"word{i % 977} and more" for i in range(40_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, "   \n\t ", "en", None, 6), (4, "One", "en", "a", 3),
        (5, "one", "en", "a", 3), (5, "one", "en", "a", 3), (None, "one", "en", "a", 3), (6, long, "en", "a", len(long)),
        (7, long + " tail", "en", "a", None), (8, "Straße é 中文 \U0001f600 the end, of it", "de", "b", 30),
    ]
    return spark.createDataFrame([(*r, "clash") for r in rows], DOCUMENTS + ", score string")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)
