import pytest


@pytest.fixture
def table(spark):
    """A table of documents with columns whose names the operators use themselves."""

    def make(rows, names="doc_id bigint, text string"):
        return spark.createDataFrame(rows, names)

    return make


#: Nulls, empty and blank texts, ties, repeated rows, a long text.
ODD = [
    (1, "one two three four five six seven eight nine ten"),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "one two three four five six seven eight nine ten"),
    (5, "one two three four five six seven eight nine ten"),
    (None, "no identifier here, é ü 日本 😀 password=abc123def"),
    (7, "word " * 30_000),
    (8, "x" * 50_000),
]


@pytest.fixture
def odd(table):
    return table(ODD)


@pytest.fixture
def odd_extra(spark):
    """The same rows with null columns and clashing names."""
    rows = [(*r, None, 1, "z", None) for r in ODD]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, source string, n int, row string, `_order` string"
    )


@pytest.fixture
def empty(table):
    return table([])
