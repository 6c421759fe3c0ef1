"""Small tables every operator must cope with."""

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(start: int, count: int) -> str:
    return " ".join(f"w{start + i}" for i in range(count))


#: nulls in every column, empty and blank texts, repeats, ties, a very long text and odd characters
ODD = [
    (1, words(0, 60), "en", "a", 0), (2, words(0, 60), "en", "a", 0), (2, words(0, 60), "en", "a", 0), (3, None, "en", "b", 0), (4, "", None, None, None),
    (5, " \t\n ", "de", "b", 0), (None, words(500, 30), "en", "a", 0), (6, "one two", "en", None, 0), (7, "One TWO", "en", None, 0),
    (8, words(2000, 30_000), "en", "c", 0), (9, "İ Σ é́ 😀 <|endoftext|> it's x\x00y", "xx", "c", 0), (None, None, None, None, None),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def clashing():
    """Adds columns whose names differ in case only or are names of results."""

    def add(df, *names):
        return df.select("*", *(F.lit(1).alias(n) for n in (*names, "Text", "DOC_ID", "key", "size", "root")))

    return add
