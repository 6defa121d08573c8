import pytest

from pyspark.sql import types as T

DOC = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])

LONG = "alpha beta gamma delta " * 30_000
EDGE_TEXTS = [
    (1, "One two three four five six seven."), (2, "One two three four five six seven."), (3, None), (4, ""),
    (5, " \t\n "), (6, "É ß 漢字 \x00 end"), (7, LONG), (8, LONG), (8, LONG), (None, "no id"), (9, "one"),
    (10, "two  spaces and\ttabs\n here"), (11, "..,,!! 123 456"), (12, "ONE TWO three FOUR five six seven."),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and a column of a clashing name."""
    rows = [(i, t, "en" if i and i % 2 else None, None if i == 5 else f"s{(i or 0) % 3}", len(t or "")) for i, t in EDGE_TEXTS]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def clashing(edge):
    from pyspark.sql import functions as F
    names = ["block", "size", "key", "n", "start", "fp", "owner", "score", "shard", "node"]
    return edge.withColumns({c: F.lit("x") for c in names})
