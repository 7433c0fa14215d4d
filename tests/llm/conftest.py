import pytest

from govmill.llm.shared import ship


@pytest.fixture(scope="session")
def llm(spark):
    """The session, with the package shipped to its Python workers."""
    return ship(spark)


@pytest.fixture
def docs(llm):
    def make(rows, schema="doc_id bigint, text string"):
        return llm.createDataFrame(rows, schema)

    return make


#: Nulls, empty and odd texts that every operator over documents must take.
ODD = [(None, "one two three"), (1, None), (2, ""), (3, " \t\n"), (4, "word"), (5, "é ñ ß 漢字 \U0001F600"), (6, "a " * 20000),
       (7, "x" * 30000), (8, "same text as the next"), (9, "same text as the next"), (9, "same text as the next"), (10, "\x00\x1f odd")]


@pytest.fixture
def odd():
    return ODD
