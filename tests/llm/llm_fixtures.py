import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture
def docs(spark):
    """Documents from (id, text[, lang[, source]]) rows."""
    def make(rows):
        full = [(r[0], r[1], *(list(r[2:]) + [None, None])[:2], len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


