import pytest
from odd_rows import EXTRA, ROWS
from pyspark.sql import types as T

@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and clashing extra columns."""
    kinds = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                          T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                          T.StructField("n_chars", T.LongType()),
                          *[T.StructField(c, T.StringType()) for c in EXTRA]])
    rows = [(*r, *(None if i % 2 else "x" for i in range(len(EXTRA)))) for r in ROWS]
    return spark.createDataFrame(rows, kinds).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def few_labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (4, 1, 0), (4, 0, 1), (8, 0, 1), (10, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
