import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """A small table of the cases that every operator has to stand."""

    def make(texts, extra=True):
        rows = [(i, t, None if i % 3 else "en", None, 1, "x") for i, t in enumerate(texts)]
        schema = "doc_id long, text string, lang string, source string, n_chars long, spans string"
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
