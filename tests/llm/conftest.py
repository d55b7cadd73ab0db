import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """(id, text) pairs as a documents table; None is null in any column."""

    def make(*rows):
        full = [(i, t, None, "src0", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make
