"""The sample of labels is taken from those of documents that are there."""

from pyspark.sql import functions as F

from haulage.llm import quality
from test_models import junk, speak


def test_labels_of_missing_documents_take_no_place(spark, frame):
    rows = [(i, junk(i) if i % 2 else speak("aa", i), "aa", "s", 0) for i in range(40)]
    docs = frame(rows).select(F.col("doc_id").alias("id"), "text", F.struct(F.lit(0.0).alias("n_chars")).alias("meta"))
    labels = spark.createDataFrame([(i, float(i % 2)) for i in range(40)], "id bigint, label double") \
        .union(spark.range(1000, 9000).select("id", F.lit(1.0)))
    alone = quality.train(docs, labels.where("id < 1000"), F.lit(True), sample=30)
    mixed = quality.train(docs, labels, F.lit(True), sample=30)
    assert mixed is not None and (mixed.w == alone.w).all()
