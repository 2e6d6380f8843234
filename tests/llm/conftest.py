import pytest
from pyspark.sql import functions as F

from skylag.llm.registry import prepared

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, size string, "
    "_key string, node long, kept boolean, token_ids string"
)
LONG = " ".join(f"Wort{i % 997} läuft" for i in range(20_000))
TEXTS = [
    (1, "One two three four five six seven."), (2, "one  TWO three four five six seven."),
    (3, None), (4, ""), (5, " \t\n "), (6, LONG), (7, LONG + " end"), (None, "no id here"),
    (None, None), (8, "a"), (9, "a"), (10, "One two three four five six seven."),
    (11, "One two three four five six seven."), (11, "One two three four five six seven."),
    (12, "Ünï ▁ \U0001F600   x" + "\r\n\v\f"),
]


@pytest.fixture(scope="session")
def llm(spark):
    return prepared(spark)


@pytest.fixture(scope="session")
def edges(llm):
    """Nulls, empty and long texts, ties, repeated rows, and columns with names used inside."""
    rows = [(i, t, None, None if i == 1 else f"s{(i or 0) % 2}", None, 1.5, "x", "k", 7, None, None) for i, t in TEXTS]
    return llm.createDataFrame(rows, SCHEMA).repartition(3, F.col("text"))


@pytest.fixture(scope="session")
def empty(llm):
    return llm.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(llm):
    return llm.createDataFrame(
        [(i, 1, i % 2) for i in range(13)] + [(None, None, 1), (3, None, None)], "doc_id long, quality int, toxic int"
    )
