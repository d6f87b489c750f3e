import pytest

COLUMNS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) pairs, with columns whose names the operators use themselves."""

    def make(*pairs, lang="en"):
        rows = [(i, t, lang, "s", None, 1, "x", "y") for i, t in pairs]
        return spark.createDataFrame(rows, COLUMNS + ", score LONG, _q STRING, _text STRING")

    return make
