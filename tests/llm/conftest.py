import pytest
from llm_cases import EDGE

from qaprep.llm.common import session


@pytest.fixture(scope="session")
def llm(spark):
    return session(spark)


@pytest.fixture(scope="session")
def edge_rows():
    return EDGE


@pytest.fixture(scope="session")
def edge_docs(llm):
    """The edge cases with columns whose names operators use inside."""
    rows = [(i, t, "en", "x", 0, "k", 1, 2.0) for i, t in EDGE]
    return llm.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, node int, score double").repartition(3)


@pytest.fixture(scope="session")
def no_docs(llm):
    return llm.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")


@pytest.fixture(scope="session")
def vocab():
    P = pytest.importorskip("public_tokenizers")
    return P
