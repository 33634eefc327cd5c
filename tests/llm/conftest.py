import pytest

from optlake.llm.common import Scratch, prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def llm(spark):
    return prepare(spark)


@pytest.fixture
def scratch(llm):
    return Scratch(llm)


@pytest.fixture
def docs(llm):
    """Frame of documents from texts or (id, text) pairs, with columns whose names clash with the operators' own."""
    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return llm.createDataFrame([(i, t, "en", "s", len(t or ""), 7, "x", 0.5) for i, t in rows],
                                   DOCS + ", n int, rep string, score double")

    return make
