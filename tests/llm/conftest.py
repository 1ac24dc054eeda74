import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts, or from (doc_id, text, lang, source) rows."""
    from partflow.llm.common import prepare
    prepare(spark)

    def make(rows):
        full = []
        for i, r in enumerate(rows):
            if not isinstance(r, tuple):
                r = (i, r, "en", "a")
            full.append((*r, None if r[1] is None else len(r[1])))
        return spark.createDataFrame(full, DOCS)
    return make
