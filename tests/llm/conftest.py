import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A documents table from (id, text) pairs."""
    def make(rows):
        return spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in rows], DOC)
    return make


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
