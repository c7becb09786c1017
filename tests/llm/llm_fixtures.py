"""Fixtures of these tests (a second conftest would hide the first one)."""

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture
def make(spark):
    """A documents table from (doc_id, text[, lang[, source]]) tuples, with
    extra columns whose names operators use inside."""
    def build(rows, *extra):
        from pyspark.sql import functions as F

        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        for i, name in enumerate(extra):
            df = df.withColumn(name, F.lit(i))
        return df
    return build
