import pytest
from odd_rows import ODD


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of documents with two columns whose names the operators use themselves."""

    def make(rows, columns="doc_id bigint, text string"):
        extra = [(*r, "x", 7) for r in rows]
        return spark.createDataFrame(extra, columns + ", fingerprint string, kept int")

    return make


@pytest.fixture(scope="session")
def odd(frame):
    return frame(ODD)


@pytest.fixture(scope="session")
def nothing(frame):
    return frame([])
