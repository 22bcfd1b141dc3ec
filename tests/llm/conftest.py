import pytest

from creelgrid.llm.base import ship

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) with columns that clash with results."""

    def build(rows, **extra):
        names = "".join(f", {k} string" for k in extra)
        return spark.createDataFrame([(i, t, *extra.values()) for i, t in rows], f"doc_id long, text string{names}")

    return build


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and blank texts, a very long text, ties, repeated rows, ids that are null, clashing columns."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "The same text here, with some words."), (6, "The same text here, with some words."),
        (6, "The same text here, with some words."), (None, "A text without an id"), (None, None), (7, long), (8, "x" * 5000), (9, "ÀÉÎ ß 　 🙂 naïve"),
        (10, "!!! ??? ..."), (11, "12 34"),
    ]
    return make_docs(rows, n_tokens="clash", score="clash", labels="clash", digest="clash", kept="clash", lang="en", label="clash")
