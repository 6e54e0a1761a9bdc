import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [T.StructField(n, t) for n, t in (
        ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()),
        # Columns whose names the operators use inside.
        ("item", T.StringType()), ("key", T.StringType()), ("kind", T.StringType()), ("score", T.StringType()), ("part", T.StringType()),
        ("shard", T.StringType()), ("held_out", T.StringType()), ("row", T.StringType()), ("words", T.StringType()),
    )]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of documents from (doc_id, text) pairs."""

    def make(rows, parts=3):
        full = [(i, t, "en", None, None, "x", None, "y", "z", None, "s", "h", "r", "w") for i, t in rows]
        return spark.createDataFrame(full, DOCUMENT).repartition(parts)

    return make


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
