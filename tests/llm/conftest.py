import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A table of documents from texts or (text, lang, source); ids count from 0."""

    def make(texts, schema=DOCUMENTS):
        rows = []
        for number, text in enumerate(texts):
            text, lang, source = text if isinstance(text, tuple) else (text, "en", "src0")
            rows.append((number, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def by_id():
    def collect(df, id="doc_id"):
        return {row[id]: row for row in df.collect()}

    return collect
