from pyspark.sql import functions as F

from trailmix.llm.quality import model_counts


def test_every_trusted_document_counts(spark):
    n = 25_000
    docs = spark.range(n + 5).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    counts = model_counts(docs, labels.union(labels), "doc_id", "text", 50)
    assert counts.agg(F.sum("trusted"), F.sum("raw")).collect()[0] == (3 * n, 3 * (n + 5))
