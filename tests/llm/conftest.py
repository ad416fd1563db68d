import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) pairs, with columns that operators must not mind."""

    def make(pairs, schema="doc_id long, text string, id long, unit string, gram string, a string"):
        return spark.createDataFrame([(i, t, 1, "u", None, "a") for i, t in pairs], schema)

    return make
