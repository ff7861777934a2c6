import pytest

from gridledger.llm import common

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return common.table(spark, SF, "documents")


@pytest.fixture(scope="session")
def labels(spark):
    return common.table(spark, SF, "labels")


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs, empty, tiny, repeated and long rows, and columns whose names clash with internal ones."""
    long_text = "one two three four five six seven " * 3000
    rows = [(1, "", "en"), (2, None, None), (None, "alpha beta gamma delta epsilon zeta", "en"), (3, "word", "en"),
            (3, "word", "en"), (4, long_text, "en"), (5, long_text, None), (6, "\x00▁ !? 日本", "ja"), (7, "12 34", None)]
    return spark.createDataFrame([(*r, "s", 1, 2.0, 7) for r in rows],
                                 "doc_id long, text string, lang string, node string, n int, score double, length int")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
