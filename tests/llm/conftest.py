import pytest

from starloom.llm import shared


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    shared.prepare_workers(spark)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with those the operators make."""

    def build(*rows):
        given = [(i, t, "x", 1, True, -1.0) for i, t in rows]
        return spark.createDataFrame(given, "doc_id long, text string, id string, row_number int, kept boolean, n_tokens double")

    return build
