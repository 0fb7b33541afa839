import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture(scope="session")
def docs(spark):
    """A small table of documents from (id, text) pairs, in several partitions."""

    def make(rows):
        return spark.createDataFrame(rows, DOCS).repartition(3)

    return make
