import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())]
    # names that the operators use inside
    + [T.StructField(name, T.StringType()) for name in
       ("id", "node", "digest", "label", "band", "keep", "score", "ids", "part", "locator", "class_id", "row")])

LONG = " ".join(f"word{i % 5000}" for i in range(120_000))
ROWS = [
    (None, None), (None, "a text without an id of its own and some more words"), (1, None), (2, ""), (3, "   \n\t "),
    (4, "One"), (5, "one"), (6, "two words"), (6, "two words"), (6, "two words"), (7, LONG), (8, LONG + " end"),
    (9, "É à ü 😀 <|endoftext|>  x"), (9, "the same id with another text"), (10, "x" * 100_000),
    (11, "Licensed under the Apache License, Version 2.0."), (-5, "a negative id"),
]


def fill(spark, rows):
    return spark.createDataFrame(
        [(i, t, None, None if k % 3 else f"src{k % 2}", None, *["x"] * 12) for k, (i, t) in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, empty and very long texts, ties, repeated rows, and further columns."""
    return fill(spark, ROWS)


@pytest.fixture(scope="session")
def none(spark):
    return fill(spark, [])


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
