import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (id, text) pairs, with extra columns whose names clash
    with those that the operators use inside."""
    def make(rows, parts=3):
        from pyspark.sql import functions as F
        df = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS).repartition(parts)
        return df.withColumn("key", F.lit(1)).withColumn("_text", F.lit("x")).withColumn("n_words", F.lit(7))
    return make
