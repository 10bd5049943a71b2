import pytest

from hard_rows import ROWS, SF


@pytest.fixture(scope="session")
def docs(spark):
    """The hard rows, with extra columns whose names clash with working names."""
    return spark.createDataFrame([(i, t, l, s, len(t or ""), 1, "x", i) for i, t, l, s in ROWS],
                                 "doc_id long, text string, lang string, source string, n_chars long, size int, q_key string, gone long").repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")


@pytest.fixture(scope="session")
def sample(spark):
    """All documents of the smallest table."""
    return spark.read.parquet(f"{SF}/documents.parquet")
