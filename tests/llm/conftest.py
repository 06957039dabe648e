import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                          T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text[, lang, source]) as a documents table, with extra columns of clashing names."""
    def make(rows, extra=()):
        rows = [(*r, *(None,) * (4 - len(r)), None) for r in rows]
        schema = T.StructType([*DOCUMENTS.fields, *(T.StructField(c, T.StringType()) for c in extra)])
        return spark.createDataFrame([(*r, *("x",) * len(extra)) for r in rows], schema)
    return make
