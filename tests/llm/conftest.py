import pytest


@pytest.fixture
def odd(spark):
    """A function that makes documents of odd rows and of the given texts.

    Null ids and texts, repeated rows, an empty and a long text, and further
    columns whose names the operators use themselves.
    """
    schema = (
        "doc_id long, text string, lang string, row long, key string, line int, id string, "
        "shard int, label string, score double, kept string, number int"
    )

    def make(texts=(), rows=None):
        if rows is None:
            rows = [(None, None), (1, None), (2, ""), (3, "x"), (3, "x"), (None, "some words here"), (4, "very long " * 30_000)]
            rows += list(enumerate(texts, 10))
        return spark.createDataFrame(
            [(i, t, "en", 1, "k", 1, "id", 1, "l", 0.5, "kept", 1) for i, t in rows], schema
        )

    return make
