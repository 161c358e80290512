import pytest
from pyspark.sql import types as T

DOC = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) pairs, with columns whose names clash with
    those that the operators add or use."""

    def make(rows, extra=("score", "n_words", "n", "id", "key", "epoch", "ids", "rest")):
        schema = T.StructType(
            [
                T.StructField("doc_id", T.LongType()),
                T.StructField("text", T.StringType()),
                *[T.StructField(c, T.StringType()) for c in extra],
            ]
        )
        return spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], schema)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    words = [f"w{i % 7919}" for i in range(60_000)]
    return [
        (1, None),
        (None, "alpha beta gamma"),
        (2, ""),
        (3, " \t\n\x0b "),
        (4, " ".join(words)),
        (5, "one two three"),
        (5, "one two three"),
        (6, "one two three"),
        (7, "x" * 200_000),
        (8, "é ß 中文 z \x1c q"),
        (None, None),
    ]
