import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from texts or (doc_id, text) pairs, with every other column null."""
    def make(rows):
        pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, None, None, None) for i, t in pairs], DOC_SCHEMA)
    return make
