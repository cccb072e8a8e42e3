import pytest

CLASHES = "score DOUBLE, predicted INT, fp LONG, spans STRING, h LONG, k LONG, n LONG, key LONG, kept STRING, ids STRING, text_ STRING"


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents out of (doc_id, text), with more columns whose names operators use themselves."""

    def build(rows):
        extra = tuple([None] * len(CLASHES.split(",")))
        schema = f"doc_id LONG, text STRING, lang STRING, n_chars LONG, {CLASHES}"
        return spark.createDataFrame([(i, t, None, None, *extra) for i, t in rows], schema).repartition(3)

    return build


@pytest.fixture(scope="session")
def messy(documents):
    """Nulls, empty and white texts, repeated rows, one id with two texts, and a long text."""
    return documents([
        (1, "some words that stand here. and more of them"), (1, "some words that stand here. and more of them"),
        (2, None), (3, ""), (4, " \n\t "), (None, "a text without an id"), (None, None), (5, "x" * 200_000),
        (6, "word " * 30_000), (7, "one"), (7, "two"), (8, "é日本𝄞 \u0085 　 ñ"),
    ])
