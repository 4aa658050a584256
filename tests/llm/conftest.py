import pytest


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """Documents with nulls in every column, empty and repeated texts, and a clashing extra column."""
    rows = [(1, "Alpha beta gamma delta epsilon.", "en", "s", 31, 1.0), (2, None, "en", "s", None, 2.0), (3, "", None, None, 0, 3.0),
            (None, "alpha beta", "en", "s", 10, 4.0), (5, "Alpha beta gamma delta epsilon.", "fr", "s", 31, 5.0),
            (5, "Alpha beta gamma delta epsilon.", "fr", "s", 31, 5.0), (6, " \t\n ", "en", None, 4, None), (7, "12 34 !!", "en", "s", 8, 1.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double")


@pytest.fixture
def none(documents):
    return documents.limit(0)
