import pytest
from pyspark.sql import types as T


@pytest.fixture
def documents(spark):
    """Builds a documents table from (doc_id, text[, lang[, source]]), with a column whose name the operators use inside."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("_group", T.StringType())])

    def build(rows):
        full = [(*r, *(None,) * (4 - len(r))) for r in rows]
        return spark.createDataFrame([(i, t, g, s, None if t is None else len(t), "extra") for i, t, g, s in full], schema)

    return build
